"""Order-dependent operators that stay balanced when one group is huge.

``Window.partitionBy(group).orderBy(x)`` sends a whole group to one task; if a
single run or query holds a third of the rows, that task does a third of the
work.  Here the order values are cut into slices of about ``rows`` rows of the
whole table (boundaries are sampled quantiles, taken once on the driver, so
every task retry and every branch of the plan agrees on them); windows run per
(group, slice), which spreads a hot group over many tasks.  Where no group has
more rows than a slice (one aggregate tells), plain windows do.  A table with one
row per (group, slice) carries the prefix from earlier slices; joining it back
on (group, slice) keeps that join balanced too.  The first ``order`` column
must be numeric, and the rows must come out the same when they are read again
(store them first where they do not).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_AGG = {"min": F.min, "max": F.max, "sum": F.sum}


#: Rows of the whole table in one slice, and the most slices.
SLICE_ROWS = 1 << 16
MOST_SLICES = 4096
#: Rows that a task is meant to sort, where their number is known.
TASK_ROWS = 1 << 18
_BLOCK = 64


def _slice_of(value, bounds: list):
    """Number of ascending ``bounds`` up to ``value``, looked up in blocks."""
    blocks = [bounds[i:i + _BLOCK] for i in range(0, len(bounds), _BLOCK)]
    upto = lambda xs: F.size(F.filter(xs, lambda b: b <= value))
    block = F.greatest(upto(F.array(*[F.lit(b[0]) for b in blocks])), F.lit(1))
    inside = F.element_at(F.array(*[F.array(*[F.lit(x) for x in b]) for b in blocks]), block)
    return (block - 1) * _BLOCK + upto(inside)


def spread(df: DataFrame, keys, parts: int) -> DataFrame:
    """``df`` dealt by ``keys`` to ``parts`` tasks at least: Spark's own number of partitions
    does not grow with a table, so that a task's rows would."""
    if parts <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartition(*keys)
    return df.repartition(parts, *keys)


def group_sizes(df: DataFrame, keys) -> tuple[int, int]:
    """Rows of the largest group and of the whole table (one job)."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    size = sizes.agg(F.max("_n").alias("most"), F.sum("_n").alias("total")).first()
    return size["most"] or 0, size["total"] or 0


def slice_bounds(df: DataFrame, keys, order, rows: int = SLICE_ROWS, sizes: tuple | None = None) -> list:
    """Ascending values of the first ``order`` column at which slices begin; none when no group
    is larger than a slice.  One job (none with the ``group_sizes`` given), and a second one only for
    tables with a large group.  Callers with several windows over one table pass the result to each."""
    keys, order = list(keys), list(order)
    most, total = sizes or group_sizes(df, keys)
    if most <= rows:
        return []
    slices = min(MOST_SLICES, -(-total // rows))
    return sorted(set(df.approxQuantile(order[0], [i / slices for i in range(1, slices)], 0.25 / slices)))


def _sliced(df: DataFrame, keys, order, rows: int, bounds: list | None):
    keys, order = list(keys), list(order)
    bounds = slice_bounds(df, keys, order, rows) if bounds is None else bounds
    if not bounds:
        return None, keys, order
    r = df.withColumn("_pid", F.coalesce(_slice_of(F.col(order[0]).cast("double"), bounds), F.lit(-1)))
    return spread(r, keys + ["_pid"], len(bounds) + 1), keys, order


def positions_within(df: DataFrame, keys, order, out: str = "pos", rows: int = SLICE_ROWS,
                     bounds: list | None = None) -> DataFrame:
    """Dense 1-based position of each row within its group, in ``order``
    (ties broken arbitrarily but consistently)."""
    r, keys, order = _sliced(df, keys, order, rows, bounds)
    if r is None:  # no group is larger than a slice
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(out, F.row_number().over(w).cast("bigint"))
    part = keys + ["_pid"]
    local = r.withColumn("_lp", F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
    # slice sizes from the numbered rows (same partitioning, no new shuffle)
    counts = local.groupBy(*part).agg(F.max("_lp").alias("_c"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = (counts.withColumn("_off", F.sum("_c").over(before)).where(F.col("_off") > 0)
                  .select(*part, "_off"))
    # only slices after a group's first carry an offset: a small side, which
    # AQE broadcasts once its runtime size is known to be under the threshold
    j = local.join(offs, part, "left")
    return j.withColumn(out, (F.col("_lp") + F.coalesce("_off", F.lit(0))).cast("bigint")).drop("_lp", "_off", "_pid")


def running(df: DataFrame, keys, order, value: str, agg: str, out: str, inclusive: bool = True,
            rows: int = SLICE_ROWS, bounds: list | None = None) -> DataFrame:
    """Running ``agg`` (min, max or sum) of ``value`` within each group in
    ``order``: over earlier rows and the current one (``inclusive``) or over
    earlier rows only (NULL when there are none)."""
    f = _AGG[agg]
    r, keys, order = _sliced(df, keys, order, rows, bounds)
    part = keys + ["_pid"] if r is not None else keys
    w = Window.partitionBy(*part).orderBy(*order)
    if r is None:
        return df.withColumn(out, f(value).over(w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)))
    frame = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local = r.withColumn("_loc", f(value).over(frame))
    summ = local.groupBy(*part).agg(f(value).alias("_s"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    prev = summ.withColumn("_prev", f("_s").over(before)).where(F.col("_prev").isNotNull()).select(*part, "_prev")
    j = local.join(prev, part, "left")
    if agg == "sum":
        combined = F.when(F.col("_prev").isNull() & F.col("_loc").isNull(), F.lit(None)).otherwise(
            F.coalesce("_prev", F.lit(0)) + F.coalesce("_loc", F.lit(0)))
    else:
        pick = F.least if agg == "min" else F.greatest
        combined = pick("_prev", "_loc")  # least/greatest skip NULLs
    return j.withColumn(out, combined).drop("_loc", "_prev", "_pid")
