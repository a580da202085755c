"""Language identification by segmentation-marginalised unigrams.

Each language has probabilities for the pieces of a fixed public vocabulary.
A word's probability is the sum over all its segmentations into pieces, which
a forward pass computes; a text's is the product over its words.  The piece
probabilities are fitted by expectation maximisation (forward-backward) on
the whole texts of at most ``SAMPLE`` documents per language, taken by hash.

Words are maximal runs of letters (Unicode category L) in lower case, of any
length: in runs over ``LONGEST`` letters the forward pass goes letter by letter
in logarithms and carries only the values that a piece can still reach back to.
The language with the highest posterior (all languages
alike beforehand) wins, ties to the smaller name; its posterior is the score.

Edge cases: a text that is null or has no letter is ``und`` with score 0, as
is every text when no language could be learned; rows with a null language or
text teach nothing, nor do rows without an id; ids may repeat, each row is
scored by itself; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import python_ready

VOCABULARY = "piece_bpe_32k.model"
#: Documents per language that the model is fitted on.
SAMPLE = 400
#: Words over this many letters are scored one by one, letter by letter.
LONGEST = 40
ROUNDS = 4
#: Added to each piece's expected count.
PRIOR = 0.01
#: Pieces of text a worker remembers the scores of.
MEMO = 400_000
_LETTERS = regex.compile(r"\p{L}+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def vocabulary(path: str) -> list[str]:
    """Pieces of letters, some after the mark that begins a word."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if regex.fullmatch(r"▁?\p{L}*", p) and p)


def words_of(text: str) -> list[str]:
    """Words with the mark that begins them."""
    return ["▁" + w for w in _LETTERS.findall(text.lower())]


@dataclass
class Model:
    languages: list[str]
    pieces: list[str]
    #: (pieces + 2) x languages; the last but one row is a letter that no piece has, the last is 0.
    probability: np.ndarray
    index: dict[str, int] = field(init=False)
    longest: int = field(init=False)
    scorer: object = field(init=False, default=None)

    def __post_init__(self):
        #: pieces by their letters; beginnings that are no piece themselves map to -1
        self.index = {p[:k]: -1 for p in self.pieces for k in range(2, len(p))}
        self.index.update((p, i) for i, p in enumerate(self.pieces))
        self.longest = max(map(len, self.pieces), default=1)

    def lattice(self, words: list[str]) -> np.ndarray:
        """Row of the piece that starts at each letter with each length: words x letters x lengths."""
        n, steps = len(self.pieces), max(map(len, words))
        at = np.full((len(words), steps, min(self.longest, steps)), n + 1, np.int32)
        get, most = self.index.get, 1
        for k, w in enumerate(words):
            for i in range(len(w)):
                at[k, i, 0] = get(w[i], n)
                for j in range(i + 2, len(w) + 1):
                    p = get(w[i:j])
                    if p is None:
                        break
                    if p >= 0:
                        at[k, i, j - i - 1] = p
                        most = max(most, j - i)
        return at[:, :, :most]

    def forward(self, words: list[str], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums over the segmentations of each beginning, and of the words."""
        alpha = np.zeros((at.shape[1] + 1, len(words), len(self.languages)))
        alpha[0] = 1
        for i in range(at.shape[1]):
            for m in range(min(at.shape[2], at.shape[1] - i)):
                alpha[i + m + 1] += alpha[i] * self.probability[at[:, i, m]]
        ends = alpha[[len(w) for w in words], np.arange(len(words))]
        return alpha, ends

    def starting(self, word: str, i: int) -> list[tuple[int, int]]:
        """Length and row of every piece that starts at letter ``i``."""
        n = len(self.pieces)
        found = [(1, self.index.get(word[i], n))]
        for j in range(i + 2, len(word) + 1):
            p = self.index.get(word[i:j])
            if p is None:
                break
            if p >= 0:
                found.append((j - i, p))
        return found

    def logs(self) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.log(self.probability)

    def long_score(self, word: str, logs: np.ndarray) -> np.ndarray:
        """Log probability of one word of any length; only the next ``longest`` forward values are held."""
        none = np.full(len(self.languages), -np.inf)
        ahead = deque([np.zeros(len(self.languages))] + [none] * self.longest)
        for i in range(len(word)):
            here = ahead.popleft()
            ahead.append(none)
            for m, p in self.starting(word, i):
                ahead[m - 1] = np.logaddexp(ahead[m - 1], here + logs[p])
        return ahead[0]

    def long_counts(self, word: str, logs: np.ndarray, times: np.ndarray, expected: np.ndarray) -> None:
        """Adds the expected uses of each piece in one word, ``times`` of it by language (forward-backward)."""
        n, found = len(word), [self.starting(word, i) for i in range(len(word))]
        alpha = np.full((n + 1, len(self.languages)), -np.inf)
        beta = alpha.copy()
        alpha[0] = beta[n] = 0
        for i in range(n):
            for m, p in found[i]:
                alpha[i + m] = np.logaddexp(alpha[i + m], alpha[i] + logs[p])
        for i in range(n - 1, -1, -1):
            for m, p in found[i]:
                beta[i] = np.logaddexp(beta[i], logs[p] + beta[i + m])
        used = times > 0
        for i in range(n):
            for m, p in found[i]:
                expected[p, used] += times[used] * np.exp(alpha[i, used] + logs[p, used] + beta[i + m, used] - alpha[n, used])

    def score(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        out = np.zeros((len(words), len(self.languages)))
        order = sorted((k for k in range(len(words)) if len(words[k]) <= LONGEST), key=lambda k: len(words[k]))
        for k in range(0, len(order), 4096):
            own = order[k:k + 4096]
            part = [words[i] for i in own]
            out[own] = np.log(np.maximum(self.forward(part, self.lattice(part))[1], 1e-300))
        if len(order) < len(words):
            logs = self.logs()
            for k, w in enumerate(words):
                if len(w) > LONGEST:
                    out[k] = self.long_score(w, logs)
        return out


def fit(counts: dict[tuple[str, str], int], pieces: list[str], rounds: int = ROUNDS) -> Model:
    """Piece probabilities from counts by (language, word)."""
    languages = sorted({lang for lang, _ in counts})
    words = sorted({w for _, w in counts}, key=lambda w: (len(w), w))
    n = np.zeros((len(words), len(languages)))
    place, column = {w: i for i, w in enumerate(words)}, {x: i for i, x in enumerate(languages)}
    for (lang, w), c in counts.items():
        n[place[w], column[lang]] = c
    rows = len(pieces) + 2
    model = Model(languages, pieces, np.full((rows, len(languages)), 1 / rows))
    model.probability[-1] = 0
    short = sum(len(w) <= LONGEST for w in words)  # words go by their length
    parts = [range(k, min(k + 8192, short)) for k in range(0, short, 8192)]
    lattices = [model.lattice([words[i] for i in p]) for p in parts]
    for _ in range(rounds):
        expected = np.zeros((rows, len(languages)))
        for part, at in zip(parts, lattices):
            own = [words[i] for i in part]
            alpha, ends = model.forward(own, at)
            beta = np.zeros_like(alpha)
            beta[[len(w) for w in own], np.arange(len(own))] = 1
            share = n[part.start:part.stop] / np.maximum(ends, 1e-300)
            for i in range(at.shape[1] - 1, -1, -1):
                for m in range(min(at.shape[2], at.shape[1] - i)):
                    p = model.probability[at[:, i, m]]
                    beta[i] += p * beta[i + m + 1]
                    use = alpha[i] * p * beta[i + m + 1] * share
                    for c in range(len(languages)):
                        expected[:, c] += np.bincount(at[:, i, m], use[:, c], rows)
        logs = model.logs()
        for k in range(short, len(words)):
            model.long_counts(words[k], logs, n[k], expected)
        expected[-1] = 0
        expected[:-1] += PRIOR
        model.probability = expected / expected.sum(0)
    return model


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: Counter = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found.update((lang, w) for w in words_of(text))
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()),
                                          pa.array(found.values(), pa.int64())], ["lang", "word", "n"])


def train(docs: DataFrame, teaches: Column, sample: int = SAMPLE, vocab_path: str | None = None) -> Model:
    """A model from rows where ``teaches`` holds."""
    python_ready(docs.sparkSession)
    usable = docs.filter(teaches & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    # the least hashes of each language: one limited ordering each, so that no language meets in one task
    languages = [r["lang"] for r in usable.select("lang").distinct().orderBy("lang").collect()]
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = usable.select("doc_id").limit(0)
    for lang in languages:
        chosen = chosen.unionByName(usable.filter(F.col("lang") == lang).select("doc_id").orderBy(*by_hash).limit(sample))
    texts = usable.select("doc_id", "lang", "text").join(F.broadcast(chosen.distinct()), "doc_id", "left_semi")
    counts = texts.select("lang", "text").mapInArrow(_count, "lang string, word string, n long")
    rows = counts.groupBy("lang", "word").agg(F.sum("n").alias("n")).collect()
    return fit({(r["lang"], r["word"]): r["n"] for r in rows}, vocabulary(vocab_path or vocabulary_path()))


class Scorer:
    """Scores whole texts; the scores of pieces between white space are remembered."""

    def __init__(self, model: Model, memo: int = MEMO):
        self.model, self.memo = model, memo
        self.row: dict[str, int] = {}
        self.known = np.zeros((1024, len(model.languages)))

    def _learn(self, pieces: set[str]) -> None:
        pieces = [p for p in pieces if p not in self.row]
        if len(self.row) + len(pieces) > self.memo:
            self.row.clear()
        words, owner = [], []
        for k, p in enumerate(pieces):
            own = words_of(p)
            words += own
            owner += [k] * len(own)
        base = len(self.row)
        if base + len(pieces) > len(self.known):
            self.known = np.concatenate([self.known[:base], np.zeros((max(len(pieces), base), len(self.model.languages)))])
        sums = np.zeros((len(pieces), len(self.model.languages)))
        if words:
            np.add.at(sums, owner, self.model.score(words))
        self.known[base:base + len(pieces)] = sums
        self.row.update((p, base + k) for k, p in enumerate(pieces))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        cut = [(t or "").lower().split() for t in texts]
        new: set[str] = set()
        for c in cut:
            new.update(c)
        if any(p not in self.row for p in new):
            before = len(self.row)
            self._learn(new)
            if len(self.row) < before + 1 or any(p not in self.row for p in new):  # the memo began anew
                self._learn(new)
        names, scores = [], []
        for t, c in zip(texts, cut):
            if not c or not self.model.languages or not _LETTERS.search(t):
                names.append("und")
                scores.append(0.0)
                continue
            total = self.known[np.fromiter(map(self.row.__getitem__, c), np.int64, len(c))].sum(0)
            best = int(total.argmax())
            names.append(self.model.languages[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return names, scores


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text."""
    python_ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # pieces x languages: bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer = shared.value.scorer or Scorer(shared.value)  # one per worker process
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                names, scores = scorer.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                                 ["doc_id", "lang_pred", "score"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
