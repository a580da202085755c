"""Tokens that occur in two or more documents, found by a packed exchange.

Tokens are 64-bit numbers that a function makes from each whole text.  A task
packs the tokens of a batch of documents into one binary per bucket, so rows
stay few and no token is a row of its own.  A bucket is sorted with numpy and
gives back, packed by document part, the tokens with two documents or more.

Tokens of very many documents would fill one bucket.  A token in at least a
``HEAVY``-th of all documents is in that share of at least one batch, so a
first pass finds all of them (and only a bounded number can exist); the heavy
ones are known to repeat and skip the exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy

#: A token is heavy from this share of documents on, 1 / HEAVY, and this number of them.
HEAVY, FLOOR = 512, 20_000
#: Documents of one batch.
BATCH = 2048
#: Tokens that a bucket holds, about.
BUCKET_TOKENS = 1_500_000

ENTRY, SIZE, FOUND = 0, 1, 2
SCHEMA = "kind int, key int, docs binary, tokens binary, numbers binary"
_NAMES = ["kind", "key", "docs", "tokens", "numbers"]
#: Sorted distinct tokens of each text.
Tokens = Callable[[list[str]], list[np.ndarray]]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers evenly."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    return x


def part_of(docs: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(docs.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) % np.uint64(parts)).astype(np.int64)


def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Ids, texts and further columns of at most ``BATCH`` documents at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, BATCH):
            part = batch.slice(k, BATCH)
            if part.num_rows:
                yield part.column(0).to_numpy(zero_copy_only=False).astype(np.int64), *(c.to_pylist() for c in part.columns[1:])


def row(kind: int, key: int, docs=b"", tokens=b"", numbers=b"") -> tuple:
    return kind, int(key), bytes(docs), bytes(tokens), bytes(numbers)


def record(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    columns = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], _NAMES)


def frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_NAMES)


def common_in_batch(tokens: list[np.ndarray], share: int = HEAVY) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of at least a ``share``-th of a batch's documents (and two), and their counts."""
    every = np.sort(np.concatenate(tokens)) if tokens else np.zeros(0, np.uint64)
    heads = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.zeros(0, int)
    counts = np.diff(np.r_[heads, len(every)])
    many = counts >= max(2, len(tokens) / share)
    return every[heads[many]], counts[many]


def heavy_of(counted: DataFrame, documents: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted heavy tokens and their counted documents, of rows ``token, n`` from all batches.

    Batches leave out counts below their share, so half of it is asked for: at
    most 2 * HEAVY times the tokens of an average document pass.  A token of
    under half of ``FLOOR`` documents fills no bucket."""
    heavy = counted.groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(FLOOR, documents / HEAVY) / 2)
    got = heavy.toArrow()
    tokens = np.asarray(got.column("token"), np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.asarray(got.column("n"), np.int64)[order]


def heavy_tokens(docs: DataFrame, tokens_of: Tokens, documents: int) -> tuple[np.ndarray, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in batches_of(batches):
            token, n = common_in_batch(tokens_of(texts))
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n, pa.int64())], ["token", "n"])
    return heavy_of(docs.mapInArrow(run, "token long, n long"), documents)


def is_heavy(tokens: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens are heavy, and the place where each is or would be."""
    at = np.searchsorted(heavy, tokens)
    if not len(heavy):
        return np.zeros(len(tokens), bool), at
    return heavy[np.minimum(at, len(heavy) - 1)] == tokens, at


def _entries(tokens_of: Tokens, heavy, buckets: int, parts: int, sizes: bool, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = heavy.value
        for docs, texts in batches_of(batches):
            tokens = tokens_of(texts)
            own = np.array([len(t) for t in tokens], np.int64)
            who = np.repeat(np.arange(len(docs), dtype=np.uint16), own)
            every = np.concatenate(tokens)
            hot, at = is_heavy(every, known)
            rows = []
            if sizes:  # documents' sizes and heavy tokens go straight to their parts
                through = int(docs[0]) % buckets
                part = part_of(docs, parts)
                hot_part = part[who[hot]]
                for p in np.unique(part):
                    rows.append((through, row(SIZE, p, docs[part == p].tobytes(), b"", own[part == p].tobytes())))
                    here = hot_part == p
                    if here.any():
                        rows.append((through, row(FOUND, p, docs[who[hot][here]].tobytes(), every[hot][here].tobytes(),
                                                  counts[at[hot][here]].tobytes())))
            every, who = every[~hot], who[~hot]
            bucket = (mixed(every) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            table = steps(docs)
            for b in np.flatnonzero(np.diff(ends)):
                at = order[ends[b]:ends[b + 1]]
                ids, named = table, who[at]
                if len(at) < len(docs):  # only ids in use, so that their share doesn't grow with the buckets
                    used, place = np.unique(named, return_inverse=True)
                    ids, named = steps(docs[used]), place.astype(np.uint16)
                rows.append((b, row(ENTRY, b, ids, short(every[at], width), steps(named))))
            plain = record([r for _, r in rows])
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), *plain.columns], ["bucket", *_NAMES])
        tidy()
    return run


def steps(numbers: np.ndarray) -> bytes:
    """Numbers as compressed differences: ids of a batch and places in it mostly go up by little."""
    return zstandard.ZstdCompressor(1, write_checksum=False).compress(np.diff(numbers, prepend=numbers.dtype.type(0)).tobytes())


def summed(data: bytes, kind: type) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind), dtype=kind)


def short(tokens: np.ndarray, width: int) -> bytes:
    """The lower ``width`` bytes of each token."""
    return tokens.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def long(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view(np.uint64)[:, 0]


def _found(parts: int, width: int, back: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = [row(*r) for r in rows.loc[rows["kind"] != ENTRY, _NAMES].itertuples(index=False)]
        entries = rows[rows["kind"] == ENTRY]
        if len(entries):
            tokens = np.concatenate([long(t, width) for t in entries["tokens"]])
            docs = np.concatenate([summed(d, np.int64)[summed(w, np.uint16)] for d, w in zip(entries["docs"], entries["numbers"])])
            order = np.argsort(tokens, kind="stable")
            tokens, docs = tokens[order], docs[order]
            heads = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
            counts = np.diff(np.r_[heads, len(tokens)])
            several = np.minimum.reduceat(docs, heads) != np.maximum.reduceat(docs, heads)
            keep = np.repeat(several, counts)
            tokens, docs, counts = tokens[keep], docs[keep], np.repeat(counts, counts)[keep]
            part = part_of(docs, parts)
            order = np.lexsort((docs, part))
            ends = np.searchsorted(part[order], np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(ends)):
                at = order[ends[p]:ends[p + 1]]
                out.append(row(FOUND, p, docs[at].tobytes(), short(tokens[at], back), counts[at].tobytes() if back == 8 else b""))
            del tokens, docs, counts, part, order
        tidy()
        return frame(out)
    return run


def repeated(docs: DataFrame, tokens_of: Tokens, heavy: tuple[np.ndarray, np.ndarray], buckets: int, parts: int,
             sizes: bool = False, width: int = 8, back: int = 8) -> DataFrame:
    """Packed rows by document part (``key``): the tokens that other documents hold too, with their counts of
    documents; with ``sizes`` also each document's number of tokens and its heavy tokens.

    Where a token more does no harm, tokens may travel by their lower ``width`` bytes, and come back by their
    lower ``back`` bytes (then without counts)."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)
    sent = docs.mapInArrow(_entries(tokens_of, shared, buckets, parts, sizes, width), "bucket int, " + SCHEMA)
    return sent.groupBy("bucket").applyInPandas(_found(parts, width, back), SCHEMA)
