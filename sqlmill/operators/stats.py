"""Dataset statistics of (input, output) samples (A4) and their percentages (A5).

One pass: every figure is a ``count_if``/``avg`` in a single aggregate, which
Spark evaluates map-side (partial) and merges after a tiny shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: verb prefixes and substring features, tested on upper-cased SQL
VERBS = ("SELECT", "INSERT", "UPDATE", "DELETE")
FEATURES = (
    ("with_join", ("JOIN",)),
    ("with_group_by", ("GROUP BY",)),
    ("with_order_by", ("ORDER BY",)),
    ("with_limit", ("LIMIT",)),
    ("with_subquery", ("(SELECT", "( SELECT")),
    ("with_aggregate", ("COUNT(", "SUM(", "AVG(", "MAX(", "MIN(")),
)
COUNT_COLUMNS = ("n_select", "n_insert", "n_update", "n_delete", "n_other") + tuple(f for f, _ in FEATURES)


def dataset_stats(df: DataFrame, group=(), inp="input", out="output") -> DataFrame:
    """A4.  The verb test has no trim; substring features are plain ``contains``
    on the upper-cased text (so ``CREDIT_LIMIT`` counts as LIMIT).  Mean lengths
    are in characters, rounded half-even to 2 places; the raw means are kept."""
    u = F.upper(F.col(out))
    starts = [u.startswith(v) for v in VERBS]
    aggs = [F.count(F.lit(1)).alias("total_samples")]
    for v, s in zip(VERBS, starts):
        aggs.append(F.count_if(s).alias(f"n_{v.lower()}"))
    any_verb = starts[0] | starts[1] | starts[2] | starts[3]
    aggs.append(F.count_if(~any_verb).alias("n_other"))
    for name, subs in FEATURES:
        cond = u.contains(subs[0])
        for s in subs[1:]:
            cond = cond | u.contains(s)
        aggs.append(F.count_if(cond).alias(name))
    aggs.append(F.coalesce(F.avg(F.length(inp)), F.lit(0.0)).alias("avg_input_length_raw"))
    aggs.append(F.coalesce(F.avg(F.length(out)), F.lit(0.0)).alias("avg_output_length_raw"))
    g = df.groupBy(*group).agg(*aggs)
    return (g.withColumn("avg_input_length", F.bround("avg_input_length_raw", 2))
             .withColumn("avg_output_length", F.bround("avg_output_length_raw", 2)))


def dataset_stats_pct(stats: DataFrame, group=()) -> DataFrame:
    """A5: long form (group…, stat, count, pct) with ``pct = count / total * 100``,
    0 for an empty dataset."""
    pairs = ", ".join(f"'{c}', {c}" for c in COUNT_COLUMNS)
    long = stats.selectExpr(*group, "total_samples",
                            f"stack({len(COUNT_COLUMNS)}, {pairs}) as (stat, count)")
    pct = F.coalesce(F.try_divide(F.col("count"), F.col("total_samples")) * 100, F.lit(0.0))
    return long.select(*group, "stat", "count", pct.alias("pct"))
