"""Uniform shuffle into shards of exact sizes by a communication matrix.

Rows lie in logical partitions.  How many rows partition p sends to shard s is
drawn from the multivariate hypergeometric distribution, so that row and
column sums hold exactly; rows are permuted inside their partition, the first
``a[p][0]`` go to shard 0 and so on, and each shard is permuted again.  The
result is a uniform permutation cut into shards whose row counts differ by at
most one (law ``rows``; groups of equal texts have no part in it).

Plan: the rows with their partition and two random keys are written once, so
retries and later readers agree.  The driver sees one count per logical
partition (at most ``PARTITIONS``) and draws the matrix; it joins back as a
literal table of that bounded size.  A shard's order is cut into ``CELLS``
ranges of its random key, so that slots are numbered in 16 * 1024 pieces.

Edge cases: null ids and texts are rows like others, repeated rows each get a
slot, an empty table gives no rows, fewer rows than shards leave shards empty;
texts of any length travel once; further columns come along whatever their
names, but columns named ``shard`` and ``slot`` are replaced.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import stored

#: Most logical partitions: bounds the matrix to PARTITIONS * shards counts.
PARTITIONS = 4096
#: Pieces in which one shard's slots are numbered.
CELLS = 1024


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Good items among ``draws`` taken without return, by inversion from the mode outwards."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))

    def choose(n, k):
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    peak = math.exp(choose(good, mode) + choose(bad, draws - mode) - choose(good + bad, draws))
    u = rng.random() - peak
    left = right = mode
    p_left = p_right = peak
    while u > 0:
        moved = False
        if right < high:
            p_right *= (good - right) * (draws - right) / ((right + 1) * (bad - draws + right + 1))
            right += 1
            u -= p_right
            moved = True
            if u <= 0:
                return right
        if left > low:
            p_left *= left * (bad - draws + left) / ((good - left + 1) * (draws - left + 1))
            left -= 1
            u -= p_left
            moved = True
            if u <= 0:
                return left
        if not moved:  # the last bits of rounding
            return mode
    return mode


def communication_matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows each partition sends to each shard; columns differ by at most one."""
    rng = random.Random(seed)
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = []
    for n in counts:
        rest, left, row = sum(room), n, []
        for s in range(shards):
            k = hypergeometric(rng, room[s], rest - room[s], left)
            rest -= room[s]
            left -= k
            row.append(k)
        room = [r - k for r, k in zip(room, row)]
        matrix.append(row)
    return matrix


def shuffle_to_shards(rows: DataFrame, shards: int = 16, seed: int = 7) -> DataFrame:
    """``rows`` with all columns plus ``shard`` and ``slot`` (gapless from 0)."""
    spark = rows.sparkSession
    # the row travels as one struct, so that no column of it can clash with a helper
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    rows = rows.select(F.struct(F.lit(0).alias("_"), *[F.col(c) for c in names]).alias("_row"))
    at = stored(rows.withColumn("_p", F.expr(f"spark_partition_id() % {PARTITIONS}"))
                .withColumn("_n", F.monotonically_increasing_id())
                .withColumn("_k1", F.xxhash64(F.lit(seed), F.col("_n")))
                .withColumn("_k2", F.xxhash64(F.lit(seed + 1), F.col("_k1"), F.col("_n"))), "shard-rows")
    counts = sorted((r["_p"], r["n"]) for r in at.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect())
    matrix = communication_matrix([n for _, n in counts], shards, seed)
    values = ", ".join(f"({p}, array({', '.join(f'{x}L' for x in row)}))" for (p, _), row in zip(counts, matrix))
    sends = spark.sql(f"select * from values {values or f'(0, array({", ".join(["0L"] * shards)}))'} as t(_p, _sends)")
    # running sums: shard s takes the local positions from ends[s - 1] up to ends[s]
    ends = sends.select("_p", F.expr("transform(_sends, (x, i) -> aggregate(slice(_sends, 1, i + 1), 0L, (a, b) -> a + b))").alias("_ends"))
    local = W.partitionBy("_p").orderBy("_k1", "_n")
    sent = (at.withColumn("_rn", F.row_number().over(local)).join(F.broadcast(ends), "_p")
            .withColumn("shard", F.expr("size(filter(_ends, e -> e < _rn))")).drop("_ends", "_rn"))
    sent = stored(sent.withColumn("_cell", F.expr(f"cast(pmod(shiftrightunsigned(_k2, 40), {CELLS}) as int)")), "shard-sent")
    sizes = sent.groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("_size"))
    before = W.partitionBy("shard").orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("shard", "_cell", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy("shard", "_cell").orderBy("_k2", "_n")
    return (sent.withColumn("_rn", F.row_number().over(inside)).join(F.broadcast(offsets), ["shard", "_cell"])
            .select(*[F.col("_row")[c].alias(c) for c in names], "shard", (F.col("_offset") + F.col("_rn") - 1).cast("long").alias("slot")))


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 7) -> None:
    """Texts as shard folders, each file in slot order."""
    (shuffle_to_shards(docs, shards, seed).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").mode("overwrite").parquet(path))
