"""Interaction of document filters: what each removes, in every order, and its Shapley value.

Filters are applied one after the other; a document goes at the first one it
fails.  What a set of filters removes does not depend on their order, so all
figures follow from one table per part: documents by the set of filters they
fail.  From it come the removals of every coalition of filters (32 for five).
Step figures are differences between coalitions.  A filter's Shapley value is
the solution of the kernel-weighted least squares problem whose values are the
coalitions' removals, constrained to sum to the removal of all filters.  Its
normal equations are solved in rationals; as the solution is linear in the
removals, they are solved once, for unit removals, and each part only takes
integer products with the solution.

Plan: one scan computes a bit mask and a 256-bit digest per document (stored,
narrow).  Copies are found by partial minima per digest.  The table has at
most 2^n rows per part after a partial aggregate; all else runs on it.

Edge cases of ``failures``: a null text is empty, a null ``lang`` the part
``''`` (as is an empty one); a document without an id is no copy of any and
has no labels; rows that repeat an id are no copies of each other, each
counts; a repeated id in ``labels`` is good (toxic) if any of its rows says so;
an empty table gives no parts; further columns are not read.  Texts are
compared whole, by their SHA-256.  Very long texts stay in one row; their
words are an array of that row.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

SPACES = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Names of the filters of ``failures``, by bit: short, repetitive, shouting, marks, copy.
NAMES = "ABCDE"


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, fails, good, toxic`` per document; bit i of ``fails`` is filter i of ``NAMES``."""
    text = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("lang", F.lit("")).alias("part"),
                       F.coalesce("text", F.lit("")).alias("t"))
    words = text.select("id", "part", "t", F.array_remove(F.split("t", SPACES), "").alias("w"))
    counts = words.select("id", "part", "t", F.size("w").alias("n"), F.size(F.array_distinct("w")).alias("kinds"),
                          F.length("t").alias("points"))
    conditions = [F.col("n") < 100,
                  100 * F.col("kinds").cast("long") < 80 * F.col("n").cast("long"),
                  100 * (F.col("points") - F.length(F.translate("t", UPPER, ""))).cast("long") > 10 * F.col("points").cast("long"),
                  F.col("t").rlike("[#$%&*|]")]
    rows = stored(counts.select("id", "part", _mask(conditions).alias("fails"), F.unhex(F.sha2("t", 256)).alias("sha")), "audit-rows")
    copied = (rows.filter("id is not null").groupBy("sha").agg(F.min("id").alias("least"), F.max("id").alias("most"))
              .filter("least < most").select("sha", "least"))
    marks = (labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
             .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    copy = F.when(F.coalesce(F.col("id") > F.col("least"), F.lit(False)), 1 << 4).otherwise(0)
    false = F.lit(False)
    return rows.join(copied, "sha", "left").join(marks, "id", "left").select(
        "part", F.col("fails").bitwiseOR(copy).alias("fails"),
        F.coalesce("good", false).alias("good"), F.coalesce("toxic", false).alias("toxic"))


def _mask(conditions: list[Column]) -> Column:
    out = F.lit(0)
    for i, c in enumerate(conditions):
        out = out + F.when(c, 1 << i).otherwise(0)
    return out.cast("int")


def coalitions(rows: DataFrame, filters: int) -> DataFrame:
    """Per part: ``total`` and ``removed``, whose entry s holds the documents (all, good, toxic)
    that fail a filter of coalition s (a bit set)."""
    cells = rows.groupBy("part", "fails").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    table = cells.groupBy("part").agg(F.sum("n").alias("total"), F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))
    gone = ", ".join(f"'{c}', aggregate(cells, 0L, (a, x) -> a + if((x.fails & s) != 0, x.{c}, 0L))" for c in ("n", "good", "toxic"))
    return table.select("part", "total", F.expr(f"transform(sequence(0, {2 ** filters - 1}), s -> named_struct({gone}))").alias("removed"))


def shapley_solution(filters: int) -> list[list[Fraction]]:
    """Row i, entry s: what one document removed by coalition s adds to filter i's Shapley value.

    Minimises sum over proper coalitions s of k(s) (v(s) - sum of phi over s)^2 with
    k(s) = (n - 1) / (C(n, |s|) |s| (n - |s|)), subject to the sum of all phi being v(all)."""
    n, full = filters, 2 ** filters - 1
    if n == 1:
        return [[Fraction(0), Fraction(1)]]
    # rows: one normal equation per filter, then the constraint; columns: phi, the multiplier, then v(s)
    rows = [[Fraction(0)] * (n + 1 + full + 1) for _ in range(n + 1)]
    for s in range(1, full):
        k = s.bit_count()
        weight = Fraction(n - 1, comb(n, k) * k * (n - k))
        inside = [i for i in range(n) if s >> i & 1]
        for i in inside:
            for j in inside:
                rows[i][j] += weight
            rows[i][n + 1 + s] += weight
    for i in range(n):
        rows[i][n] = rows[n][i] = Fraction(1)
    rows[n][n + 1 + full] = Fraction(1)
    for i in range(n + 1):
        pivot = next(r for r in range(i, n + 1) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(n + 1):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    return [row[n + 1:] for row in rows[:n]]


def report(tables: DataFrame, names: str) -> DataFrame:
    """One row per part, order of the filters and step, from ``coalitions``; ``shapley`` is summed over all orders."""
    n, full = len(names), 2 ** len(names) - 1
    times = [[x * factorial(n) for x in row] for row in shapley_solution(n)]
    assert all(x.denominator == 1 for row in times for x in row)
    weights = F.array(*[F.array(*[F.lit(int(x)).cast("long") for x in row]) for row in times])
    shares = F.transform(weights, lambda row: F.aggregate(
        F.zip_with(row, F.col("removed"), lambda w, r: w * r["n"]), F.lit(0).cast("long"), lambda a, b: a + b))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(names)])
    steps = (tables.withColumn("shares", shares).withColumn("filter_order", F.explode(orders))
             .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n)))))
    bits = f"aggregate(sequence(1, step), 0, (a, k) -> a | shiftleft(1, instr('{names}', substring(filter_order, k, 1)) - 1))"
    steps = steps.withColumn("i", F.expr(f"instr('{names}', substring(filter_order, step, 1)) - 1")).withColumn("after", F.expr(bits))
    own = "shiftleft(1, i)"
    lost = "removed[after].{0} - removed[after ^ " + own + "].{0}"
    return steps.select(
        "part", "filter_order", "step", F.expr("total - removed[after].n").alias("kept"), F.expr(lost.format("n")).alias("removed"),
        F.expr(f"removed[{own}].n - ({lost.format('n')})").alias("redundant"),
        F.expr(f"removed[{full}].n - removed[{full} ^ {own}].n").alias("unique_fails"),
        F.expr(lost.format("good")).alias("good_lost"), F.expr(lost.format("toxic")).alias("toxic_lost"), F.expr("shares[i]").alias("shapley"))
