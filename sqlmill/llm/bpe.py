"""Byte-level BPE with a minimal acyclic transducer as lexicon.

The most frequent words of the corpus are encoded once and compiled into a
minimal acyclic automaton (shared prefixes and suffixes) whose arc outputs add
up to a word's number; the number points at its ids.  The arrays lie in one
file that Spark ships to every executor and workers map into memory.  Words
that the lexicon lacks are merged exactly by the vocabulary's ranked pairs.

Results equal the ``tokenizers`` library with the same file and
``add_special_tokens=False``: the added token's string in a text is its id.

Edge cases: a null text counts as empty and has no ids; unknown columns are
left out; ids of a row may be null or repeat; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import mmap
import os
import re
import struct
import tempfile
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import python_ready, stored

VOCABULARY = "byte_bpe_50k.json"
#: Words compiled into the lexicon: bounds its file and what the driver sees.
LEXICON_WORDS = 65_536
#: Entries that a worker remembers; further words are looked up again.
MEMO = 300_000
#: Distinct pieces a counting task holds before it hands them on.
COUNTED = 400_000
#: Documents in one output batch.
OUT_ROWS = 256
END = "<|endoftext|>"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, n = [""] * 256, 0
    for b in range(256):
        letters[b] = chr(b) if b in plain else chr(0x100 + n)
        n += b not in plain
    return letters


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        to_byte = {c: b for b, c in enumerate(byte_letters())}
        vocab = model["model"]["vocab"]
        self.tokens: dict[int, bytes] = {i: bytes(to_byte[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.tokens.update({i: t.encode() for t, i in self.special.items()})
        self.first = [vocab[c] for c in byte_letters()]
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for k, pair in enumerate(model["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault(vocab[a] << 20 | vocab[b], k)
            self.merged.append(vocab[a + b])
        self.rank_of = self.rank.get
        self.none = len(self.merged)
        #: Rank of each pair of bytes, the first of them times 256 more.
        self.byte_rank = [self.rank_of(a << 20 | b, self.none) for a in self.first for b in self.first]

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the lowest-ranked pair first, leftmost among equals."""
        if len(word) > 48:
            return self._merge_long(word)
        first, byte_rank, rank_of, none, merged = self.first, self.byte_rank, self.rank_of, self.none, self.merged
        ids = [first[b] for b in word]
        ranks = [byte_rank[a << 8 | b] for a, b in zip(word, word[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            ids[i] = joined = merged[best]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of(ids[i - 1] << 20 | joined, none)
            if i < len(ranks):
                ranks[i] = rank_of(joined << 20 | ids[i + 1], none)
        return ids

    def _merge_long(self, word: bytes) -> list[int]:
        """The same with a heap and links, for words of any length."""
        ids: list[int | None] = [self.first[b] for b in word]
        n = len(ids)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i) for i in range(n - 1) if (r := self.rank_of(ids[i] << 20 | ids[i + 1], self.none)) < self.none]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = right[i]
            if ids[i] is None or j >= n or self.rank_of(ids[i] << 20 | ids[j], self.none) != r:
                continue
            ids[i], ids[j] = self.merged[r], None
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for a in (left[i], i):
                if a >= 0 and right[a] < n and (s := self.rank_of(ids[a] << 20 | ids[right[a]], self.none)) < self.none:
                    heapq.heappush(heap, (s, a))
        return [x for x in ids if x is not None]


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


# --- words -----------------------------------------------------------------

def _span(cat: str) -> str:
    codes = [i for i in range(0x250) if unicodedata.category(chr(i))[0] == cat]
    return "".join(f"\\u{c:04x}" for c in codes)


#: The split pattern over characters below U+0250, whose classes are stable.
_LETTER, _NUMBER, _BLANK = _span("L"), _span("N"), "\\t-\\r \\x85\\xa0"
_LATIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_BLANK}{_LETTER}{_NUMBER}]+"
                    rf"|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")
_PRE: list = []


def words_of(text: str) -> list[bytes]:
    """The words that merges never cross, in order, as bytes."""
    if text.isascii() or max(text) < "ɐ":
        return [w.encode() for w in _LATIN.findall(text)]
    if not _PRE:
        from tokenizers.pre_tokenizers import ByteLevel
        _PRE.extend([ByteLevel(add_prefix_space=False, use_regex=True), {c: b for b, c in enumerate(byte_letters())}])
    pre, to_byte = _PRE
    return [bytes(map(to_byte.__getitem__, w)) for w, _ in pre.pre_tokenize_str(text)]


class Uneven(Exception):
    """White space that a cut at single spaces would tear apart."""


def cuts(text: str) -> list[str] | None:
    """``text`` cut before each single space or newline between other
    characters, where no word reaches across; the space is left out.  None if
    the text holds other runs of white space."""
    flat = text.replace("\n", " \n")
    if "  " in flat or "\n " in flat or flat.endswith(" "):
        return None
    return flat.split(" ")


def uncut(piece: str) -> str:
    """The characters that a piece of :func:`cuts` (but the first) stands for."""
    body = piece[1:] if piece[0] == "\n" else piece
    if body and (body[0].isspace() or body[-1].isspace()):
        raise Uneven
    return piece if piece[0] == "\n" else " " + piece


# --- lexicon ---------------------------------------------------------------

def minimal_automaton(words: list[bytes]) -> list[tuple[bool, dict[int, int]]]:
    """States (final, arcs) of the minimal acyclic automaton of sorted words;
    targets come before sources, the start is last."""
    states: list[tuple[bool, dict[int, int]]] = []
    known: dict[tuple, int] = {}

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1].items()))
        if key not in known:
            known[key] = len(states)
            states.append((node[0], node[1]))
        return known[key]

    path: list[list] = [[False, {}]]
    before = b""
    for word in words:
        same = len(os.path.commonprefix([before, word]))
        while len(path) > same + 1:
            node = path.pop()
            path[-1][1][before[len(path) - 1]] = freeze(node)
        path.extend([False, {}] for _ in word[same:])
        path[-1][0] = True
        before = word
    while len(path) > 1:
        node = path.pop()
        path[-1][1][before[len(path) - 1]] = freeze(node)
    states.append((path[0][0], path[0][1]))
    return states


def displaced(rows: list[dict[int, int]]) -> tuple[list[int], int]:
    """A base for each state's row of arcs, so that base + label is a place of its own for every arc
    (widest rows first, each at the next free fit behind the last of its width), and the number of places."""
    bases = [0] * len(rows)
    taken = bytearray(1 << 16)
    low, width = 0, 0
    for state in sorted(range(len(rows)), key=lambda s: -len(rows[s])):
        labels = sorted(rows[state])
        if not labels:
            continue
        if len(labels) != width:
            low, width = 0, len(labels)
        while taken[low]:
            low += 1
        at = max(low - labels[0], 0)
        while True:
            if at + 512 > len(taken):
                taken.extend(bytes(len(taken)))
            if not any(taken[at + c] for c in labels):
                break
            at = taken.find(0, at + labels[0] + 1) - labels[0]
            if at < 0:
                at = len(taken) - labels[0]
        for c in labels:
            taken[at + c] = 1
        bases[state], low = at, at + labels[0]
    return bases, max(bases, default=0) + 256


def write_lexicon(path: str, entries: dict[bytes, list[int]]) -> None:
    """One file of arrays: each state's base, the arcs' owners (state + 1), targets and outputs by
    place, the ids' starts by word number, the ids, and the states' final marks."""
    words = sorted(w for w in entries if w)
    states = minimal_automaton(words)
    bases, places = displaced([arcs for _, arcs in states])
    owners, targets, outputs = [0] * places, [0] * places, [0] * places
    below: list[int] = []
    for state, (is_final, arcs) in enumerate(states):
        n = int(is_final)
        for label in sorted(arcs):
            k = bases[state] + label
            owners[k], targets[k], outputs[k] = state + 1, arcs[label], n
            n += below[arcs[label]]
        below.append(n)
    at, ids = [0], []
    for w in words:
        ids += entries[w]
        at.append(len(ids))
    with open(path, "wb") as f:
        f.write(struct.pack("<4I", len(states), places, len(words), len(ids)))
        for numbers in (bases, owners, targets, outputs, at, ids):
            f.write(struct.pack(f"<{len(numbers)}I", *numbers))
        f.write(bytes(final for final, _ in states))


class Lexicon:
    """The mapped file; the page cache holds it once for all workers of a machine."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
        n_states, places, n_words, n_ids = struct.unpack("<4I", self.map[:16])
        at = 16

        def numbers(n):
            nonlocal at
            part = self.map[at:at + 4 * n].cast("I")
            at += 4 * n
            return part

        self.bases, self.owners, self.targets, self.outputs = numbers(n_states), numbers(places), numbers(places), numbers(places)
        self.at = numbers(n_words + 1)
        self.ids_from, at = at, at + 4 * n_ids
        self.final = self.map[at:]
        self.start = n_states - 1

    def ids(self, word: bytes) -> bytes | None:
        """Ids as little-endian numbers, or None for a word it lacks."""
        state, number = self.start, 0
        bases, owners, targets, outputs = self.bases, self.owners, self.targets, self.outputs
        for b in word:
            k = bases[state] + b
            if owners[k] != state + 1:
                return None
            number += outputs[k]
            state = targets[k]
        if not self.final[state]:
            return None
        return bytes(self.map[self.ids_from + 4 * self.at[number]:self.ids_from + 4 * self.at[number + 1]])


# --- encoding --------------------------------------------------------------

class Memo(dict):
    """A bounded dict that computes what it lacks."""

    def __init__(self, compute, size: int = MEMO):
        self.compute, self.room = compute, size

    def __missing__(self, key):
        value = self.compute(key)
        if self.room > 0:
            self.room -= 1
            self[key] = value
        return value


class Encoder:
    def __init__(self, vocab: Vocabulary, lexicon: Lexicon | None = None, memo: int = MEMO):
        self.vocab, self.lexicon = vocab, lexicon
        self.word = Memo(self._word, memo).__getitem__
        self.piece = Memo(self._piece, memo).__getitem__

    def _word(self, word: bytes) -> bytes:
        known = self.lexicon.ids(word) if self.lexicon else None
        if known is not None:
            return known
        ids = self.vocab.merge(word)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        return b"".join(map(self.word, words_of(uncut(piece))))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit numbers."""
        if END in text and END in self.vocab.special:
            end = struct.pack("<I", self.vocab.special[END])
            return end.join(map(self._plain, text.split(END)))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        pieces = cuts(text)
        if pieces:
            try:
                head = pieces[0]
                if head and (head[0].isspace() or head[-1].isspace()):
                    raise Uneven
                return b"".join(map(self.word, words_of(head) if head else ())) + b"".join(map(self.piece, pieces[1:]))
            except Uneven:
                pass
        return b"".join(map(self.word, words_of(text)))

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.vocab.tokens.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


@lru_cache(1)
def worker_encoder(vocab_path: str, lexicon: str) -> Encoder:
    """One per worker process, so that its memo serves all tasks."""
    return Encoder(vocabulary(vocab_path), Lexicon(SparkFiles.get(lexicon)))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces: Counter = Counter()

    def words() -> pa.RecordBatch:
        found: Counter = Counter()
        for piece, n in pieces.items():
            for w in words_of(piece):
                found[w] += n
        pieces.clear()
        return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], ["word", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            if not text:
                continue
            parts = cuts(text)
            if parts is None:
                pieces[text] += 1
            else:
                pieces[parts[0]] += 1
                pieces.update(parts[1:])
            if len(pieces) > COUNTED:
                yield _spaced(pieces, words)
    if pieces:
        yield _spaced(pieces, words)


def _spaced(pieces: Counter, words) -> pa.RecordBatch:
    """Gives pieces back the space that they were cut at."""
    whole = Counter({p if p[:1] in ("\n", "") else " " + p: n for p, n in pieces.items()})
    pieces.clear()
    pieces.update(whole)
    return words()


def frequent_words(docs: DataFrame, words: int = LEXICON_WORDS) -> list[bytes]:
    """The most frequent words of all texts: all from the least count on that
    at most ``words`` reach, so the driver never sees more than these."""
    counts = docs.select("text").mapInArrow(_count_words, "word binary, n long")
    counts = stored(counts.groupBy("word").agg(F.sum("n").alias("n")).filter("n > 1"), "bpe-words")
    level = F.floor(F.log2("n") * 32).cast("long")  # at most 2048 levels of counts
    levels = sorted((r["level"], r["words"]) for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect())
    least, taken = None, 0
    for at, n in reversed(levels):
        taken += n
        if taken > words:
            break
        least = at
    if least is None:
        return []
    return [bytes(r["word"]) for r in counts.filter(level >= least).select("word").toLocalIterator()]


def ship_lexicon(spark: SparkSession, words: list[bytes], vocab_path: str) -> str:
    """Compiles ``words`` and hands the file to every executor; returns its name."""
    vocab = vocabulary(vocab_path)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = os.path.join(os.path.realpath(tempfile.mkdtemp()), name)
    write_lexicon(path, {w: vocab.merge(w) for w in words})
    spark.sparkContext.addFile(path)
    return name


def _coded(vocab_path: str, lexicon: str, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_encoder(vocab_path, lexicon)
        for batch in batches:
            for k in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(k, OUT_ROWS)
                ids = [coder.encode(t or "") for t in part.column(1).to_pylist()]
                out = [part.column(0), pa.array(ids, pa.binary())]
                if with_text:
                    out.append(pa.array([coder.decode(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "ids", "decoded"][:len(out)])
    return run


def encode(docs: DataFrame, vocab_path: str | None = None, lexicon_words: int = LEXICON_WORDS,
           decoded: bool = False) -> DataFrame:
    """``doc_id, ids`` (little-endian 32-bit numbers) of every whole text, and
    with ``decoded`` the text that these ids decode to."""
    spark = docs.sparkSession
    python_ready(spark)
    vocab_path = vocab_path or vocabulary_path()
    lexicon = ship_lexicon(spark, frequent_words(docs, lexicon_words), vocab_path)
    schema = "doc_id long, ids binary" + ", decoded string" * decoded
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_coded(vocab_path, lexicon, decoded), schema)


def decode(coded: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``."""
    vocab_path = vocab_path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(vocabulary(vocab_path))
        for batch in batches:
            texts = [coder.decode(x or b"") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])
    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
