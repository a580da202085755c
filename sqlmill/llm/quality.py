"""Quality by compression: two zstandard dictionaries, one built from good and one from bad labelled text.

Text that resembles a dictionary's samples compresses better with it.  A text
is cut into pieces of ``PIECE`` bytes (all of them, so a long text meets the
dictionary everywhere), each piece is compressed with both dictionaries, and
the size with the bad dictionary less that with the good one, divided by the
text's own bytes plus ``SMOOTH``, is its difference.  A logistic curve turns
differences into probabilities of label 1.

The fit uses, per label, the ``DOCUMENTS`` labelled documents with the least
hashes.  Half of them (by another hash) give the dictionaries' samples, at most
``SAMPLES`` pieces per label; the other half gives the curve, whose points are
weighted by the labels' true counts.  The driver sees those pieces and two
numbers per document, whatever the texts' lengths.

Edge cases: a null or empty text has difference 0; rows without an id or label
teach nothing; a repeated id teaches its best label once; when a label is missing from the
training rows, or too small for a dictionary, every score is the share of
label 1 (0 without any label); an empty table gives no rows; further columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import python_ready

#: Labelled documents of each label that the model is fitted on.
DOCUMENTS = 3000
#: Pieces of each label that a dictionary is built from.
SAMPLES = 1500
PIECE = 2048
DICTIONARY = 1 << 16
LEVEL = 3
SMOOTH = 64
THRESHOLD = 0.7


def pieces_of(text: str | None) -> list[bytes]:
    data = (text or "").encode("utf-8", "surrogatepass")
    return [data[k:k + PIECE] for k in range(0, len(data), PIECE)]


@dataclass
class Model:
    """Dictionaries as bytes; compressors are made once per worker."""

    good: bytes | None = None
    bad: bytes | None = None
    slope: float = 0.0
    shift: float = 0.0
    prior: float = 0.0
    made: list = field(default_factory=list)

    def __getstate__(self):
        return {**self.__dict__, "made": []}

    def compressors(self) -> list:
        if not self.made:
            for data in (self.good, self.bad):
                d = zstandard.ZstdCompressionDict(data)
                d.precompute_compress(level=LEVEL)
                self.made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False))
        return self.made

    def differences(self, texts: list[str | None]) -> np.ndarray:
        good, bad = (c.compress for c in self.compressors())
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            pieces = pieces_of(text)
            sizes = sum(len(bad(p)) for p in pieces) - sum(len(good(p)) for p in pieces)
            out[i] = sizes / (sum(map(len, pieces)) + SMOOTH)
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.good is None:
            return np.full(len(texts), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.differences(texts) + self.shift, -30, 30)))


def dictionary(pieces: list[bytes]) -> bytes | None:
    """A dictionary of at most ``DICTIONARY`` bytes, or None where there is too little text for one."""
    size = min(DICTIONARY, sum(map(len, pieces)) // 4)
    try:
        return zstandard.train_dictionary(size, pieces, level=LEVEL).as_bytes() if size >= 256 else None
    except zstandard.ZstdError:  # the library finds too few samples
        return None


def curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and shift of the weighted logistic fit of ``y`` on ``x``, by Newton steps on standardised values."""
    mean, spread = np.average(x, weights=weight), max(float(x.std()), 1e-9)
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    w = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - y)) + ridge * w
        bend = (z * (weight * p * (1 - p) + 1e-9)[:, None]).T @ z + ridge * np.eye(2)
        step = np.linalg.solve(bend, slope)
        w -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
    return float(w[0] / spread), float(w[1] - w[0] * mean / spread)


def held_out() -> Column:
    """Rows whose labels only measure: a quarter, by a hash of the id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, teaches: Column, documents: int = DOCUMENTS) -> Model:
    """A model from rows of ``docs`` that have a label and where ``teaches`` holds."""
    python_ready(docs.sparkSession)
    marked = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).filter(teaches)
    marked = marked.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    marked = marked.join(texts.select("doc_id"), "doc_id", "left_semi")
    count = {r["quality"]: r["n"] for r in marked.filter("quality in (0, 1)").groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(count.values())
    prior = count.get(1, 0) / total if total else 0.0
    if len(count) < 2:
        return Model(prior=prior)
    # the least hashes of each label: each task sends at most ``documents`` ids
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = marked.filter("quality = 0").orderBy(*by_hash).limit(documents).unionByName(
        marked.filter("quality = 1").orderBy(*by_hash).limit(documents))
    rows = texts.join(F.broadcast(chosen), "doc_id").withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = pieces_of(text)
                for k in range(0, len(found), 512):
                    yield pa.RecordBatch.from_arrays([pa.array(found[k:k + 512], pa.binary())], ["piece"])

    def samples(quality: int) -> list[bytes]:
        found = rows.filter((F.col("half") == 0) & (F.col("quality") == quality)).select("text").mapInArrow(cut, "piece binary")
        found = found.distinct().orderBy(F.xxhash64("piece"), "piece").limit(SAMPLES)
        return [bytes(r["piece"]) for r in found.collect()]

    model = Model(dictionary(samples(1)), dictionary(samples(0)), prior=prior)
    if model.good is None or model.bad is None:
        return Model(prior=prior)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.differences(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["quality", "x"])

    points = sorted((r["quality"], r["x"]) for r in
                    rows.filter("half = 1").select("quality", "text").mapInArrow(measured, "quality int, x double").collect())
    y, x = (np.array(v, float) for v in zip(*points)) if points else (np.zeros(0), np.zeros(0))
    if len(set(y)) < 2:
        return Model(prior=prior)
    weight = np.where(y == 1, count[1] / (y == 1).sum(), count[0] / (y == 0).sum()) / total * len(y)
    model.slope, model.shift = curve(x, y, weight)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every whole text."""
    python_ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries: 128 KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                found = shared.value.score(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
