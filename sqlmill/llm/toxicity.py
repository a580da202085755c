"""Toxicity by a subsequence string kernel, Nystroem features and a linear SVM.

The kernel compares two units (words, or letters spelled out one by one) by
their subsequences of three characters with up to ``GAP - 1`` characters
between neighbours; each skipped character weighs ``DECAY``.  So an insult
keeps most of its likeness when characters are inserted or left out.  Units
are mapped to Nystroem features by a bounded set of landmarks, on which a
squared-hinge SVM is trained.  Sentences carry the labels: a document's score
is that of its worst sentence, a sentence's that of its worst unit, and
training alternates between choosing each toxic document's worst sentence
(none where nothing stands out: labels hold errors) and fitting, with hard
negatives from clean sentences and altered variants.

Landmarks, Nystroem map and SVM weights fold into one weight per subsequence,
so scoring a unit takes time linear in its length, whole texts included.

The fit uses at most ``SAMPLE`` labelled documents of each label, by hash.
Tasks cut them into distinct sentences of units; the driver reads these one
document at a time, numbers the units and keeps only numbers.  Landmarks touch
few of the possible subsequences, so their weights are kept for those alone.

Edge cases: a null or empty text has the score of a text without units; rows
without an id or label teach nothing; a repeated label row counts once, as toxic if any
says so; rows that repeat a document teach again but their sentences are no
further evidence; when either label is missing from the
training rows, every score is 0; an empty table gives no rows; further columns
are not read (``keep_clean`` returns them); very long texts are scored whole.
"""

from __future__ import annotations

import gc
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import python_ready, tidy

#: Labelled documents of each label that the model is fitted on.
SAMPLE = 1500
LANDMARKS = 96
#: Largest distance between neighbours of a subsequence.
GAP = 3
DECAY = 0.5
CODES = 64
SHAPES = CODES ** 3
ROUNDS = 4
THRESHOLD = 0.3
#: Least likelihood ratio by which a unit marks a sentence as toxic (the labels hold errors).
EVIDENCE = 12.0
#: Units a worker remembers the scores of.
MEMO = 150_000
#: Kernel columns that are summed at a time.
COLUMNS = 8
_OPEN, _SHUT = CODES - 2, CODES - 1
_MARKS = re.compile(r"[\W_]+")
_SPELLED = re.compile(r"(?<!\S)\w(?:\s\w){2,}(?!\S)")
_SENTENCE = re.compile(r"[.!?\n]+(?=\s|$)|\n")


def unit_of(token: str) -> str:
    """The letters and digits of a token: marks put between them are no part of a word."""
    return _MARKS.sub("", token)


def units_of(text: str) -> list[str]:
    """Lower-case tokens between white space, and runs of single characters joined."""
    low = text.lower()
    return low.split() + [re.sub(r"\s", "", m) for m in _SPELLED.findall(low)]


def _codes(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All units' character codes in a row, each between two marks, and their starts."""
    lengths = np.fromiter((len(u) for u in units), np.int64, len(units))
    points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    code = np.where((points >= 97) & (points < 123), points - 96, 27 + points % 35)
    out = np.full(int(lengths.sum()) + 2 * len(units), _SHUT, np.int64)
    starts = np.cumsum(lengths + 2) - (lengths + 2)
    out[starts] = _OPEN
    inner = np.arange(len(code)) + np.repeat(2 * np.arange(len(units)) + 1, lengths)
    out[inner] = code
    return out, starts


def subsequences(units: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each pair of distances: the unit and the shape of every subsequence, and its weight."""
    code, starts = _codes(units)
    owner = np.repeat(np.arange(len(units)), np.diff(np.append(starts, len(code))))
    for a in range(1, GAP + 1):
        for b in range(1, GAP + 1):
            n = len(code) - a - b
            if n <= 0:
                continue
            own = owner[:n]
            same = owner[a + b:] == own
            shape = (code[:n] * CODES + code[a:a + n]) * CODES + code[a + b:]
            yield own[same], shape[same], DECAY ** (a + b - 2)


def folded(units: list[str], weights: np.ndarray, index: np.ndarray | None = None) -> np.ndarray:
    """Sum over a unit's subsequences of their weights (one column per kernel
    column), divided by the unit's own norm.  With ``index``, the weights of
    shape s stand in row ``index[s]``."""
    wide = weights.ndim == 2
    total = np.zeros((len(units), weights.shape[1]) if wide else len(units))
    norm = np.zeros(len(units))
    for own, shape, decay in subsequences(units):
        if index is not None:
            shape = index[shape]
        if wide:
            for k in range(0, len(own), 1 << 16):
                part, at = own[k:k + (1 << 16)], shape[k:k + (1 << 16)]
                heads = np.flatnonzero(np.diff(part, prepend=-1))
                for c in range(0, weights.shape[1], COLUMNS):  # the driver holds few columns of a block at once
                    total[part[heads], c:c + COLUMNS] += decay * np.add.reduceat(weights[:, c:c + COLUMNS][at], heads, axis=0)
        else:
            total += np.bincount(own, decay * weights[shape], len(units))
        norm += decay ** 2 * np.bincount(own, minlength=len(units))
    norm = np.sqrt(np.maximum(norm, 1e-9))
    return total / (norm[:, None] if wide else norm)


@dataclass
class Model:
    weights: np.ndarray | None
    bias: float = 0.0
    slope: float = 0.0
    shift: float = 0.0
    memo: dict = field(default_factory=dict)

    def of_units(self, units: list[str]) -> np.ndarray:
        return folded([unit_of(u) for u in units], self.weights) + self.bias

    def worst(self, texts: list[str | None], memo: int = MEMO) -> np.ndarray:
        """Highest unit score of each text; that of no unit for texts without any."""
        cut = [units_of(t or "") for t in texts]
        new: set[str] = set()
        for c in cut:
            new.update(c)
        if len(self.memo) + len(new) > memo:
            self.memo.clear()
        new = [u for u in new if u not in self.memo]
        for k in range(0, len(new), 8192):
            part = new[k:k + 8192]
            self.memo.update(zip(part, self.of_units(part).tolist()))
        get = self.memo.__getitem__
        return np.array([max(map(get, c), default=self.bias) for c in cut])

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.slope * self.worst(texts) + self.shift, -30, 30)))


def _variants(units: list[str], rng: np.random.Generator) -> list[str]:
    """Units with a character inserted, and with one left out or replaced by a digit."""
    out = []
    for u in units:
        k, j = int(rng.integers(1, max(2, len(u)))), int(rng.integers(1, max(2, len(u))))
        out.append(u[:k] + "abcdefghijklmnopqrstuvwxyz0123456789"[rng.integers(36)] + u[k:])
        out.append(u[:j] + "0123456789"[rng.integers(10)] * int(rng.integers(2)) + u[j + 1:])
    return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0, steps: int = 25) -> np.ndarray:
    """Squared-hinge SVM by Newton steps over the margin's violators; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    active = np.ones(len(y), bool)
    for _ in range(steps):
        xa = x[active] * weight[active, None]
        w = np.linalg.solve(ridge + c * xa.T @ x[active], c * xa.T @ y[active])
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    return w


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and shift that turn scores into probabilities."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        r, s = p * (1 - p) + 1e-6, p - y
        h = np.array([[(r * x * x).sum() + ridge, (r * x).sum()], [(r * x).sum(), r.sum() + ridge]])
        da, db = np.linalg.solve(h, [(s * x).sum() + ridge * a, s.sum() + ridge * b])
        a, b = a - da, b - db
    return float(a), float(b)


def _grams(unit: str) -> list[str]:
    marked = f"<{unit}>"
    return [marked[i:i + 5] for i in range(max(1, len(marked) - 4))]


def _evidence(bad: int, n_bad: int, good: int, n_good: int) -> float:
    """Likelihood ratio (twice its log) of a share that is higher in toxic documents, else 0."""
    if bad * n_good <= good * n_bad:
        return 0.0
    share = (bad + good) / (n_bad + n_good)
    out = bad * np.log(bad / n_bad / share)
    return float(2 * (out + (good * np.log(good / n_good / share) if good else 0.0)))


def sentences_of(text: str) -> list[str]:
    """The distinct sentences of a text, as units between spaces."""
    found = dict.fromkeys(" ".join(u for t in units_of(s) if (u := unit_of(t))) for s in _SENTENCE.split(text))
    return [s for s in found if s]


def landmark_columns(landmarks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Kernel weights of the landmarks (one column each) over the shapes that occur in any,
    and each shape's row there (row 0 for all others)."""
    found = [[(shape, decay) for _, shape, decay in subsequences([u])] for u in landmarks]
    shapes = np.unique(np.concatenate([shape for f in found for shape, _ in f] or [np.zeros(0, np.int64)]))
    index = np.zeros(SHAPES, np.int32)
    index[shapes] = np.arange(1, len(shapes) + 1)
    columns = np.zeros((len(shapes) + 1, len(landmarks)))
    for k, f in enumerate(found):
        for shape, decay in f:
            np.add.at(columns[:, k], index[shape], decay)
        columns[:, k] /= max(float(np.sqrt(sum(decay ** 2 * len(shape) for shape, decay in f))), 1e-9)
    return columns, index


def fit(docs: Iterable[tuple[list[str], int]], seed: int = 11) -> Model:
    """A model from documents (distinct sentences, as of ``sentences_of``) and their labels."""
    rng = np.random.default_rng(seed)
    number: dict[str, int] = {}
    gram_number: dict[str, int] = {}
    grams_of: list[list[int]] = []
    n = Counter()
    # documents of each label that hold a unit, and a run of characters of it
    seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
    parts: dict[int, Counter] = {0: Counter(), 1: Counter()}
    told: set[bytes] = set()
    own_units: list[np.ndarray] = []
    labels: list[int] = []
    for sentences, y in docs:
        n[y] += 1
        numbered = []
        for sentence in sentences:
            found = sentence.split(" ")
            for u in found:
                if u not in number:
                    number[u] = len(number)
                    grams_of.append([gram_number.setdefault(g, len(gram_number)) for g in _grams(u)])
            numbered.append(np.array([number[u] for u in found], np.int32))
        own = {u for s in numbered if s.tobytes() not in told for u in s.tolist()}  # copies of a sentence are no further evidence
        told.update(s.tobytes() for s in numbered)
        seen[y].update(own)
        parts[y].update({g for u in own for g in grams_of[u]})
        own_units.append(np.unique(np.concatenate(numbered)) if numbered else np.zeros(0, np.int32))
        labels.append(y)
    told.clear()
    if not (n[0] and n[1]):
        return Model(None)
    units = list(number)

    @lru_cache(None)
    def evidence(u: int) -> float:
        return max(_evidence(parts[1][g], n[1], parts[0][g], n[0]) for g in grams_of[u])

    toxic = [sorted(d.tolist(), key=units.__getitem__) for d, y in zip(own_units, labels) if y == 1 and len(d)]

    def worst_units(value, least: float) -> Counter:
        """The unit that marks each toxic document's worst sentence, where one stands out."""
        best = (max(d, key=value) for d in toxic)
        return Counter(units[u] for u in best if value(u) > least and evidence(u) > EVIDENCE)

    chosen = worst_units(evidence, EVIDENCE)
    if not chosen:
        return Model(None)
    clean = sorted(units[u] for u in seen[0])
    common = [units[u] for u, _ in sorted(seen[0].items(), key=lambda x: (-x[1], units[x[0]]))[:4000]]
    some = [str(u) for u in rng.choice(np.array(clean, object), min(6000, len(clean)), replace=False)]
    landmarks = [u for u, _ in chosen.most_common(LANDMARKS // 2)]
    landmarks += [u for u in common[:LANDMARKS - len(landmarks)] if u not in landmarks]
    columns, index = landmark_columns(landmarks)
    values, vectors = np.linalg.eigh(folded(landmarks, columns, index))
    keep = values > 1e-6
    nystroem = vectors[:, keep] / np.sqrt(values[keep])

    def scored(found: list[str]) -> np.ndarray:
        return np.concatenate([model.of_units(found[k:k + 8192]) for k in range(0, len(found), 8192)] or [np.zeros(0)])

    hard: list[str] = []
    model = Model(None)
    for _ in range(ROUNDS):
        positives = list(chosen) + _variants(list(chosen), rng) + _variants(list(chosen), rng)
        negatives = list(dict.fromkeys(common + some + hard))
        negatives += _variants(common[:500] + hard[:500], rng)
        x = folded(positives + negatives, columns, index) @ nystroem
        y = np.r_[np.ones(len(positives)), -np.ones(len(negatives))]
        times = np.sqrt(np.array([*chosen.values()], float))
        weight = np.r_[np.tile(times / times.sum(), 1), np.repeat(times, 2) / times.sum() / 4, np.repeat(times, 2) / times.sum() / 4,
                       np.full(len(negatives), 2 / len(negatives))] * len(y) / 4
        w = _svm(x, y, weight)
        model = Model((columns @ (nystroem @ w[:-1]))[index], float(w[-1]))
        hard = list(dict.fromkeys([clean[i] for i in np.argsort(-scored(clean))[:1500]] + hard))
        # each toxic document's worst sentence names the units of the next round
        of = scored(units)
        chosen = worst_units(lambda u: of[u], 0.0) or chosen
    worst = np.array([of[d].max() if len(d) else model.bias for d in own_units])
    model.slope, model.shift = _logistic(worst, np.array(labels, float))
    return model


def held_out() -> Column:
    """Rows whose labels only measure: a quarter, by a hash of the id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def teaches() -> Column:
    return ~held_out()


def train(docs: DataFrame, labels: DataFrame, teaches: Column, sample: int = SAMPLE) -> Model:
    """A model from rows of ``docs`` that have a label and where ``teaches`` holds."""
    marked = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).filter(teaches)
    marked = marked.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    present = docs.filter(F.col("text").isNotNull()).select("doc_id")
    marked = marked.join(present, "doc_id", "left_semi")
    # the least hashes of each label: each task sends at most ``sample`` ids
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = marked.filter("toxic = 0").orderBy(*by_hash).limit(sample).unionByName(
        marked.filter("toxic = 1").orderBy(*by_hash).limit(sample))
    python_ready(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                part = batch.slice(k, 1)
                found = pa.array([sentences_of(part.column(1)[0].as_py())], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([part.column(0), found, part.column(2)], ["doc_id", "sentences", "toxic"])
    rows = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    rows = rows.select(F.col("doc_id").cast("long"), "text", "toxic").mapInArrow(cut, "doc_id long, sentences array<string>, toxic int")
    found = rows.orderBy("doc_id", F.xxhash64("sentences")).toLocalIterator()  # one part of the sample at a time
    model = fit((r["sentences"], r["toxic"]) for r in found)
    gc.collect()
    tidy()  # the driver needs no more of what the fit held
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every whole text."""
    python_ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one weight per subsequence: 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                found = shared.value.score(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])
        shared.value.memo.clear()
        tidy()
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``, with all columns and without a shuffle."""
    python_ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                yield part.filter(pa.array(shared.value.score(part.column(at).to_pylist()) < threshold))
        shared.value.memo.clear()
        tidy()
    return docs.mapInArrow(run, docs.schema)
