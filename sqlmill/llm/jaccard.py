"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set holds its distinct five-word shingles (words in ASCII lower
case; with fewer words the whole sequence is one).  Two documents link when
their sets' Jaccard similarity is 0.75 or more; linked documents form
components.

All sets follow one order: tokens of few documents first.  If two documents
link, their first ``n - ceil(0.75 n) + l`` tokens share at least ``l``, for any
l.  Each document takes the l with the least estimated cost (lists to read plus
candidates to verify): longer prefixes must share correspondingly more.

Plan: documents with equal sets are collapsed to the smallest id.  Counts of
documents per token come from a packed exchange over all documents; tokens of
one document cannot match, so a document with fewer than 0.75 n shared tokens
is out, and only near copies go on.  Pairs are never listed within a token's
documents: each document is verified against the lead of the list (a star).
Most lists then lie in one component.  Only documents that stayed outside the
component of a lead are compared with other components that met the same lead,
unless the triangle inequality of the Jaccard distance (with the verified
distances to the lead) rules a link out.  So no link between components is
missed.  Everywhere, a pair is ruled out that cannot share enough: tokens of one
document alone are in no intersection, so two documents share at most the lesser
number of their other tokens.  Near copies that differ by edits of their own
fall to this before any pair is made: a document leaves a list in which even the
smallest other one would be too large for what it can share.  A pair that is
left must pass the parity maps of its tokens: where they differ, the sets do, so
their differing bits and both documents' own tokens bound the symmetric
difference from below.  Only pairs that pass all this are verified.

Edge cases: a null text, or one without words, has an empty set and links
with nothing; rows without an id have no component; rows that repeat an id
count as one document, which holds the shingles of all its texts; an empty
table gives no rows; further columns are not read (``keep_one`` returns them,
whatever their names); a very long text is one set, held by one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeated as R
from .bpe import Memo
from .common import python_ready, small_side, stored, tidy
from .components import components

WORDS = 5
#: Similarity of 0.75 as a fraction.
NUMERATOR, DENOMINATOR = 75, 100
#: Longest extension of a prefix.
MOST_MATCHES = 8
#: Cost of verifying a candidate, in list entries.
VERIFY = 8
#: Pairs verified in one group.
GROUP_PAIRS = 2000
#: Bits of the parity map of a document's shared tokens.
BITS = 2048
_STEP = np.uint64(0x9E3779B97F4A7C15)
_word = Memo(xxhash.xxh3_64_intdigest, 100_000).__getitem__


def shingles(text: str | None) -> np.ndarray:
    """The set of a text as sorted distinct 64-bit numbers."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space parts
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(_word, words), np.uint64, n)
    width = min(n, WORDS)
    h = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        h = R.mixed(h * _STEP + w[k:n - width + 1 + k])
    return np.unique(h)


def shingle_sets(documents: list[list[str | None]]) -> list[np.ndarray]:
    """The set of each document, from all its texts."""
    return [shingles(d[0]) if len(d) == 1 else np.unique(np.concatenate([shingles(None), *map(shingles, d)])) for d in documents]


def least_overlap(n: int) -> int:
    return -(-NUMERATOR * n // DENOMINATOR)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row: size and 128-bit key of its set; per batch: its common tokens."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        texts = batch.column(1).to_pylist()
        for k in range(0, len(ids), R.BATCH):
            tokens = shingle_sets(texts[k:k + R.BATCH])
            keys = [xxhash.xxh3_128_digest(t.tobytes()) for t in tokens]
            common, n = R.common_in_batch([t for t, i in zip(tokens, ids[k:k + R.BATCH]) if i is not None])
            rows = len(tokens)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[k:k + R.BATCH] + [None] * len(common), pa.int64()),
                 pa.array([len(t) for t in tokens] + n.tolist(), pa.int64()),
                 pa.array(keys + [None] * len(common), pa.binary()),
                 pa.array([None] * rows + common.view(np.int64).tolist(), pa.int64())], ["doc_id", "n", "key", "token"])
    tidy()


def matches(counts: np.ndarray, n: int, unique: int) -> int:
    """How many shared prefix tokens to ask for: the cheapest choice for ascending ``counts``."""
    base = n - least_overlap(n)
    best, least = 1, math.inf
    for m in range(1, min(MOST_MATCHES, least_overlap(n)) + 1):
        lists = float(counts[:max(base + m - unique, 0)].sum())
        cost = lists + VERIFY * lists / m
        if cost < least:
            best, least = m, cost
    return best


def _survivors(rows: pd.DataFrame) -> pd.DataFrame:
    """Documents whose shared tokens suffice for a link, with their prefix and shared tokens."""
    out: list[tuple] = []
    sizes = rows[rows["kind"] == R.SIZE]
    found = rows[rows["kind"] == R.FOUND]
    if len(sizes) and len(found):
        docs = np.concatenate([np.frombuffer(b, np.int64) for b in sizes["docs"]])
        n = np.concatenate([np.frombuffer(b, np.int64) for b in sizes["numbers"]])
        order = np.lexsort((-n, docs))
        docs, first = np.unique(docs[order], return_index=True)
        n = n[order][first]
        who = np.concatenate([np.frombuffer(b, np.int64) for b in found["docs"]])
        tokens = np.concatenate([np.frombuffer(b, np.uint64) for b in found["tokens"]])
        counts = np.concatenate([np.frombuffer(b, np.int64) for b in found["numbers"]])
        order = np.lexsort((tokens, counts, who))
        who, tokens, counts = who[order], tokens[order], counts[order]
        low, high = np.searchsorted(who, docs), np.searchsorted(who, docs, "right")
        for d in np.flatnonzero((high > low) & (DENOMINATOR * (high - low) >= NUMERATOR * n)):
            t, c = tokens[low[d]:high[d]], counts[low[d]:high[d]]
            size = int(n[d])
            unique = max(size - len(t), 0)
            m = matches(c, size, unique)
            prefix = t[:size - least_overlap(size) + m - unique]
            out.append((int(docs[d]), size, m, unique, prefix.view(np.int64), np.sort(t).tobytes(), parity(t)))
    return pd.DataFrame(out, columns=["doc", "n", "m", "u", "prefix", "tokens", "bits"])


def parity(tokens: np.ndarray) -> np.ndarray:
    """One bit per place that an odd number of tokens falls on, as 64-bit numbers."""
    odd = np.bincount((R.mixed(tokens) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _verified(key, pairs: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
    sets = {r.doc: (np.frombuffer(r.held, np.uint64), r.size, r.asked, r.front) for r in others.itertuples()}
    out = []
    for p in pairs.itertuples():
        theirs, n, m, front = sets[p.b]
        if len(np.intersect1d(p.prefix, front)) < min(p.m, m):  # too few shared prefix tokens for a link
            out.append((p.a, p.b, None, False))
            continue
        mine = np.frombuffer(p.tokens, np.uint64)
        both = len(mine) + len(theirs) - len(np.unique(np.concatenate([mine, theirs])))
        union = p.n + n - both
        out.append((p.a, p.b, 1.0 - both / union, DENOMINATOR * both >= NUMERATOR * union))
    sets.clear()
    tidy()
    return pd.DataFrame(out, columns=["a", "b", "distance", "linked"])


def may_link(n: str, shared: str, other_n: str, other_shared: str) -> str:
    """Whether the tokens that two documents do not hold alone suffice for a link (columns: sizes and these numbers)."""
    return f"{DENOMINATOR + NUMERATOR} * least({shared}, {other_shared}) >= {NUMERATOR} * ({n} + {other_n})"


def maps_may_link() -> str:
    """Whether the least symmetric difference of x and y, by their parity maps, allows a link."""
    differ = "aggregate(zip_with(x_bits, y_bits, (p, q) -> bit_count(p ^ q)), 0, (total, k) -> total + k)"
    return f"{DENOMINATOR + NUMERATOR} * (x_n + y_n - x_alone - y_alone - {differ}) >= {2 * NUMERATOR} * (x_n + y_n)"


def verify(pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """``a, b, distance, linked`` of stored pairs (no distance where the prefixes rule a link out); a document
    in many pairs is spread over groups."""
    groups = max(1, -(-pairs.count() // GROUP_PAIRS))
    salted = pairs.withColumn("salt", F.expr(f"pmod(xxhash64(a), {groups})"))
    salted = salted.withColumn("at", F.expr(f"cast(pmod(xxhash64(b, salt), {groups}) as int)")).select("a", "b", "at")
    left = salted.join(sets.select(F.col("doc").alias("a"), "n", "m", "prefix", "tokens"), "a")
    right = salted.select(F.col("b").alias("doc"), F.col("at").alias("place")).distinct().join(
        sets.select("doc", F.col("n").alias("size"), F.col("m").alias("asked"), F.col("prefix").alias("front"),
                    F.col("tokens").alias("held")), "doc")
    checked = left.groupBy("at").cogroup(right.groupBy("place")).applyInPandas(_verified, "a long, b long, distance double, linked boolean")
    return stored(checked, name)


def linked(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``."""
    spark = docs.sparkSession
    python_ready(spark)
    every = docs.select(F.col("doc_id").cast("long"), "text")
    ids = every.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    again = stored(ids.filter("n > 1").select("doc_id"), "jaccard-again")
    n_again = again.count()
    texts = every.select("doc_id", F.array("text").alias("texts"))
    if n_again:  # one row of each id, with its distinct texts
        again = small_side(again, n_again, 16)
        merged = every.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.collect_set("text").alias("texts"))
        texts = texts.join(again, "doc_id", "left_anti").unionByName(merged)
    seen = stored(texts.mapInArrow(_sets, "doc_id long, n long, key binary, token long"), "jaccard-sets")
    rows = seen.filter("key is not null").drop("token")
    usable = rows.filter("doc_id is not null and n > 0")
    classes = stored(usable.groupBy("key").agg(F.min("doc_id").alias("rep")), "jaccard-classes")
    members = rows.join(classes, "key", "left")
    total = usable.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    heavy = R.heavy_of(seen.filter("token is not null").select("token", "n"), total["rows"])

    # one document of each set
    copies = stored(members.filter("doc_id is not null and (n = 0 or doc_id != rep)").select("doc_id").distinct(), "jaccard-copies")
    reps = texts.filter("doc_id is not null").join(small_side(copies, copies.count(), 16), "doc_id", "left_anti")
    buckets = max(1, -(-total["tokens"] // R.BUCKET_TOKENS))
    packed = R.repeated(reps, shingle_sets, heavy, buckets, buckets, sizes=True)
    sets = stored(packed.groupBy("key").applyInPandas(
        _survivors, "doc long, n long, m int, u int, prefix array<long>, tokens binary, bits array<long>"), "jaccard-survivors")

    # stars: every document of a token's list with the list's lead, the one with the fewest tokens of its own
    # (of many copies that is the least edited one, to which most others are near)
    lists = sets.select("doc", "n", F.explode("prefix").alias("token"), "u")
    leads = lists.groupBy("token").agg(F.min(F.struct("u", "doc", "n")).alias("s"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    leads = leads.select("token", F.col("s.doc").alias("lead"), F.col("s.n").alias("lead_n"), (F.col("s.n") - F.col("s.u")).alias("lead_most"))
    met = stored(lists.join(leads, "token").groupBy("doc", "lead").agg(
        F.first("n").alias("n"), F.first(F.col("n") - F.col("u")).alias("most"), F.first("lead_n").alias("lead_n"),
        F.first("lead_most").alias("lead_most")), "jaccard-met")
    stars = (met.filter("doc != lead").filter(may_link("n", "most", "lead_n", "lead_most"))
             .select(F.greatest("doc", "lead").alias("a"), F.least("doc", "lead").alias("b")).distinct())
    near = verify(stored(stars, "jaccard-stars"), sets, "jaccard-near")
    labels = components(near.filter("linked").select("a", "b"), "jaccard-first")

    # documents outside their lead's component, against those of other components that met the same lead, unless
    # the distances to the lead (or what is known of them) rule a link out
    most = 1 - NUMERATOR / DENOMINATOR
    label = labels.select(F.col("node").alias("doc"), F.col("component").alias("own"))
    lead_label = labels.select(F.col("node").alias("lead"), F.col("component").alias("lead_own"))
    far = near.select("a", "b", "distance")
    low = (F.when(F.col("doc") == F.col("lead"), 0.0).when(F.col("distance").isNotNull(), F.col("distance"))
           .otherwise(F.greatest(F.lit(most), 1 - F.least("n", "lead_n") / F.greatest("n", "lead_n"))))
    high = F.when(F.col("doc") == F.col("lead"), 0.0).otherwise(F.coalesce("distance", F.lit(1.0)))
    placed = stored(met.join(label, "doc", "left").join(lead_label, "lead", "left")
                    .withColumn("a", F.greatest("doc", "lead")).withColumn("b", F.least("doc", "lead")).join(far, ["a", "b"], "left")
                    .select("doc", "lead", "n", F.col("most").alias("shared"), F.coalesce("own", "doc").alias("own"), F.coalesce("lead_own", "lead").alias("lead_own"),
                            low.alias("low"), high.alias("high")), "jaccard-placed")
    # the least size in a lead's list: documents that could not share enough even with that leave the list
    least = placed.groupBy("lead").agg(F.min("n").alias("least"))
    placed = placed.join(least, "lead").filter(f"{DENOMINATOR + NUMERATOR} * shared >= {NUMERATOR} * (n + least)")
    held = ("doc", "n", "shared", "own", "low", "high", "bits", "alone")
    placed = stored(placed.join(sets.select("doc", "bits", F.col("u").alias("alone")), "doc"), "jaccard-lists")
    x = placed.filter("own != lead_own").select("lead", *[F.col(c).alias(f"x_{c}") for c in held])
    y = placed.filter("doc != lead").select("lead", *[F.col(c).alias(f"y_{c}") for c in held])
    may = (f"x_own != y_own and {may_link('x_n', 'x_shared', 'y_n', 'y_shared')} "
           f"and x_low - y_high <= {most} + 1e-9 and y_low - x_high <= {most} + 1e-9 and {maps_may_link()}")
    pairs = (x.join(y, "lead").filter(may).select(F.greatest("x_doc", "y_doc").alias("a"), F.least("x_doc", "y_doc").alias("b"))
             .distinct().join(near.select("a", "b"), ["a", "b"], "left_anti"))
    more = verify(stored(pairs, "jaccard-more"), sets, "jaccard-rest")
    links = near.unionByName(more).filter("linked").select("a", "b")
    final = components(links, "jaccard-last").select(F.col("node").alias("rep"), F.col("component"))
    out = (members.join(final, "rep", "left")
           .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id")))
    if n_again:  # back to every row
        rows_again = every.select("doc_id").join(again, "doc_id", "left_semi")
        out = out.join(again, "doc_id", "left_anti").unionByName(rows_again.join(out, "doc_id"))
    return out


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with the smallest id of each component, and all rows without an id."""
    away = linked(docs).filter("doc_id != component_id").select("doc_id").distinct()
    return docs.join(away, "doc_id", "left_anti")
