"""Packing of tokenised documents into sequences, shortest pack first.

Every document's ids (and one id 0 after them) are cut into full pieces of
``LENGTH`` and a rest; a rest is cut once more at a multiple of ``GRAIN``, so
that short pieces are there to fill gaps.  The histogram of piece lengths (at
most ``LENGTH`` counts) is packed on the driver: lengths from the longest to
the shortest go into the pack that is filled least and still has room, and the
counts of the packing patterns are updated.  A length's pieces then fill the
patterns' places by rank, which a join with the bounded table of places does.

Plan: texts are tokenised in one pass that emits narrow pieces, which are
written once.  Ranks are numbered per (length, bucket) with bucket offsets, so
that a length that a third of all rows share is spread over ``BUCKETS`` tasks.

Edge cases: a null or empty text is the single id 0; ids of rows may be null
or repeat (each row is packed); an empty table gives no rows; further columns
are left out; a very long text is tokenised as one value of its row and cut into
as many pieces as it needs.  Sequences are padded to ``LENGTH`` by whoever writes them.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from types import SimpleNamespace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import bpe
from .common import python_ready, stored, tidy

LENGTH = 1024
#: Rests are cut at multiples of this many ids.
GRAIN = 512
#: Parts in which the pieces of one length are ranked.
BUCKETS = 64
#: Pieces and words that a worker remembers; further ones are encoded again.
MEMO, WORD_MEMO = 250_000, 10_000
#: Marks at the end of a piece, a word of their own after letters.
MARKS = ".,;:!?"
_LETTERS = re.compile(f"[{bpe._LETTER}]+").fullmatch


class LibraryEncoder(bpe.Encoder):
    """Whole texts as ids, each new word by the ``tokenizers`` library's own model.

    It outlives its task in the worker, so it holds the library's tables alone, and a piece that
    is one word once.  A word with marks behind it takes the ids of the word."""

    def __init__(self, path: str, memo: int = MEMO, word_memo: int = WORD_MEMO):
        from tokenizers import Tokenizer
        whole = Tokenizer.from_file(path)
        self.model = whole.model
        self.letters = dict(enumerate(bpe.byte_letters()))
        special = {t.content: i for i, t in whole.get_added_tokens_decoder().items()}
        super().__init__(SimpleNamespace(special=special), memo=memo)
        self.word = bpe.Memo(self._word, word_memo).__getitem__

    def _word(self, word: bytes) -> bytes:
        return self._spelled(word.decode("latin-1").translate(self.letters))

    def _spelled(self, word: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        stem = piece.rstrip(MARKS)
        if stem.isalpha() and (stem.isascii() or _LETTERS(stem)):  # most pieces: no need to look for words
            if len(stem) < len(piece):
                return self.piece(stem) + self.word(piece[len(stem):].encode())
            return self._spelled(self.letters[0x20] + stem) if stem.isascii() else self._word(b" " + stem.encode())
        words = bpe.words_of(bpe.uncut(piece))
        return self._word(words[0]) if len(words) == 1 else b"".join(map(self.word, words))


@lru_cache(1)
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def cut(n: int, length: int = LENGTH, grain: int = GRAIN) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids."""
    full, rest = divmod(n, length)
    big = rest // grain * grain
    return [length] * full + [x for x in (big, rest - big) if x]


def _pieces(path: str, length: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = library_encoder(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                rows: dict[str, list] = {c: [] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids")}
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = coder.encode(text or "") + b"\0\0\0\0"
                    start = 0
                    for size in cut(len(ids) // 4, length):
                        own = ids[4 * start:4 * (start + size)]
                        for c, v in zip(rows, (doc_id, start, size, zlib.crc32(own), len(ids) // 4, own)):
                            rows[c].append(v)
                        start += size
                if not with_ids:
                    del rows["ids"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, pa.binary() if c == "ids" else pa.int64()) for c, v in rows.items()], list(rows))
            tidy()
    return run


def pieces(docs: DataFrame, vocab_path: str | None = None, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` (and ``ids``) of each piece."""
    python_ready(docs.sparkSession)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _pieces(vocab_path or bpe.vocabulary_path(), length, with_ids), schema)


def shortest_pack_first(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns as (count, piece lengths), from counts of lengths."""
    by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        for room in range(length, size - 1, -1):
            while left and by_room[room]:
                count, pattern = by_room[room].pop()
                used = min(count, left)
                if used < count:
                    by_room[room].append((count - used, pattern))
                by_room[room - size].append((used, pattern + (size,)))
                left -= used
            if not left:
                break
        while left:  # new packs hold as many of this length as fit, but for the last
            per = min(length // size, left)
            used = left // per
            by_room[length - per * size].append((used, (size,) * per))
            left -= used * per
    return [(count, pattern) for room in sorted(by_room) for count, pattern in by_room[room]]


def places(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int]]:
    """``(length, first rank, first sequence, offset)`` of each run of places."""
    rank: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for count, pattern in patterns:
        offset = 0
        for size in pattern:
            out.append((size, rank[size], sequence, offset))
            rank[size] += count
            offset += size
        sequence += count
    return out


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` plus ``rank``: gapless from 0 within a length."""
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(BUCKETS)).cast("int"))
    sizes = rows.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = W.partitionBy("length").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("length", "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy("length", "_bucket").orderBy("doc_id", "start", "ids_crc32")
    return (rows.withColumn("_rn", F.row_number().over(inside)).join(F.broadcast(offsets), ["length", "_bucket"])
            .withColumn("rank", F.col("_before") + F.col("_rn") - 1).drop("_bucket", "_before", "_rn"))


def pack(cuts: DataFrame, length: int = LENGTH) -> DataFrame:
    """Stored pieces plus ``sequence_id`` and ``offset``."""
    spark = cuts.sparkSession
    histogram = {r["length"]: r["n"] for r in cuts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = places(shortest_pack_first(histogram, length))
    runs: dict[int, list] = defaultdict(list)
    for size, *run in table:
        runs[size].append(run)
    # one row per length: its runs of places in order of rank, at most a bounded few per length
    rows = [(size, [r[0] for r in own], [r[1] for r in own], [r[2] for r in own]) for size, own in runs.items()]
    side = spark.createDataFrame(rows, "length long, ranks array<long>, sequences array<long>, offsets array<long>")
    at = F.expr("size(filter(ranks, r -> r <= rank)) - 1")
    return (ranked(cuts).join(F.broadcast(side), "length").withColumn("_at", at)
            .withColumn("sequence_id", F.expr("sequences[_at] + rank - ranks[_at]"))
            .withColumn("offset", F.expr("offsets[_at]"))
            .drop("rank", "ranks", "sequences", "offsets", "_at"))


def pack_documents(docs: DataFrame, vocab_path: str | None = None, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    return pack(stored(pieces(docs, vocab_path, length, with_ids), "pack-pieces"), length)
