import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF
from llm_helpers import by_id, make  # noqa: F401
from sqlmill.llm import bpe, packing, queries

PATH = bpe.vocabulary_path()
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = ["", " ", "a  b", "it's\r\nwe'll 've", "日本語 ①½ x²", "<|endoftext|>a <|endoftext|>", "\n\n a\n b\n", "a\x85b \x1c\xa0c",
         "🎉 é́ ɐɑ", "x" * 5000, "ab" * 3000 + " tail", "tail \n", " lead"]


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def crc(numbers):
    return zlib.crc32(np.array(numbers, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab  .'s1\n\té日\U0001f389\x85\xa0 ́"), max_size=30))
def test_encoder_equals_library(text):
    coder = bpe.Encoder(bpe.vocabulary(PATH))
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == ids(text)
    assert coder.decode(coder.encode(text)) == text


def test_lexicon_is_minimal_and_exact(tmp_path):
    vocab = bpe.vocabulary(PATH)
    rng = random.Random(4)
    words = {"".join(rng.choice("abt") for _ in range(rng.randrange(1, 7))) + rng.choice(["ing", "tion", ""]) for _ in range(900)}
    entries = {w.encode(): vocab.merge(w.encode()) for w in words}
    path = str(tmp_path / "lexicon")
    bpe.write_lexicon(path, entries)
    lexicon = bpe.Lexicon(path)
    for w, expected in entries.items():
        assert np.frombuffer(lexicon.ids(w), "<u4").tolist() == expected
    assert lexicon.ids(b"abq") is None and lexicon.ids(b"") is None
    states = bpe.minimal_automaton(sorted(entries))
    assert len({(f, tuple(a.items())) for f, a in states}) == len(states)  # no two states alike
    assert len(states) < sum(map(len, words)) / 3


def test_op5_equals_library_on_whole_table(spark):
    out = {r["doc_id"]: r for r in queries.op5_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(out) == len(docs)
    for d in docs:
        own = ids(d["text"] or "")
        r = out[d["doc_id"]]
        assert r["n_tokens"] == len(own) and r["ids_sha256"] == hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(LIBRARY.decode(own, skip_special_tokens=False).encode()).hexdigest()


def test_encode_decode_edge_cases(make):
    docs = make([(i, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (99, None), (0, "")])
    coded = bpe.encode(docs)
    rows = coded.collect()
    assert len(rows) == len(TEXTS) + 3
    for r in rows:
        if r["doc_id"] is not None and r["doc_id"] < len(TEXTS):
            assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == ids(TEXTS[r["doc_id"]])
    back = by_id(bpe.decode(coded), "text")
    assert all(back[i] == t for i, t in enumerate(TEXTS)) and back[99] == ""
    assert bpe.encode(docs.limit(0)).count() == 0


def checked(rows, docs, length=packing.LENGTH):
    """Every id of every row lies in one piece, sequences are gapless, digests match."""
    per_doc = {}
    for r in rows:
        per_doc.setdefault(r["doc_id"], []).append(r)
    for doc_id, text in docs:
        own = ids(text or "") + [0]
        at = 0
        for r in sorted(per_doc[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(own)
            assert r["ids_crc32"] == crc(own[at:at + r["length"]])
            at += r["length"]
        assert at == len(own)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return len(sequences)


def test_op2_packs_every_id_with_little_padding(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = queries.op2_packing(spark, SF).collect()
    n = checked(rows, docs)
    assert sum(r["length"] for r in rows) > 0.97 * n * packing.LENGTH


def test_packing_edge_cases(make):
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None)]
    checked(packing.pack_documents(make(docs)).collect(), docs)
    rows = packing.pack_documents(make([(1, "same")] * 700 + [(None, "same")])).collect()
    assert len(rows) == 701
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 701
    assert packing.pack_documents(make([(1, "x")]).limit(0)).count() == 0


def test_packing_encoder_holds_little():
    """It stays in the worker: no tables beside the library's, a piece of one word once, bounded memos."""
    path = bpe.vocabulary_path()
    coder = packing.LibraryEncoder(path, memo=4, word_memo=2)
    assert not hasattr(coder.vocab, "tokens")
    pieces, words = coder.piece.__self__, coder.word.__self__
    assert coder.piece("beta") and not words
    library = Tokenizer.from_file(path)
    for text in ("alpha beta beta, gamma.\ndelta", f"é{bpe.END} x  y", "Ā ß 12345 \U0001f600 zz'll", ""):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == ids
    assert len(pieces) <= 4 and len(words) <= 2


def test_packing_encoder_tokenises_a_word_once():
    """A word is remembered whatever marks follow it; ids are the library's."""
    class Counting:
        def __init__(self, model):
            self.model, self.asked = model, []

        def tokenize(self, word):
            self.asked.append(word)
            return self.model.tokenize(word)

    coder = packing.LibraryEncoder(PATH)
    coder.model = Counting(coder.model)
    text = "x beta beta, beta. beta?! élan élan; élan."
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == ids(text)
    assert sum(w.endswith(("beta", "lan")) for w in coder.model.asked) == 2


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abs  .,!?;'1\n\té日ǅªʰɐ\x85\xa0 ́"), max_size=30))
def test_packing_encoder_equals_library(text):
    assert np.frombuffer(packing.library_encoder(PATH).encode(text), "<u4").tolist() == ids(text)


@pytest.mark.parametrize("seed", range(5))
def test_patterns_use_each_piece_once(seed):
    rng = random.Random(seed)
    histogram = Counter(rng.randrange(1, 65) for _ in range(rng.randrange(1, 5000)))
    patterns = packing.shortest_pack_first(histogram, 64)
    used = Counter()
    for count, pattern in patterns:
        assert sum(pattern) <= 64
        for size in pattern:
            used[size] += count
    assert used == histogram
    taken = Counter((size, first) for size, first, _, _ in packing.places(patterns))
    assert max(taken.values()) == 1
