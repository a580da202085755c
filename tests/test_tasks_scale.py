"""Tasks grow in number with the table, not in size."""
from pyspark.sql import functions as F

from sqlmill.operators import evaluation as ev
from sqlmill.operators import ordering
from sqlmill.operators import training as TR


def _partitions(df):
    return df.rdd.getNumPartitions()


def test_ordered_comparison_spreads(spark, monkeypatch):
    monkeypatch.setattr(ordering, "TASK_ROWS", 10)
    rows = spark.range(600).select((F.col("id") % 150).alias("query_id"), F.when(F.col("id") % 2 == 0, "ref").otherwise("pred").alias("side"),
                                   F.col("id").alias("row_idx"), F.array(F.lit("a")).alias("cells"))
    rows = rows.withColumn("query_id", F.floor(F.col("query_id") / 2)).repartition(3)
    few = ev.compare_results(rows.where("query_id < 2"))
    many = ev.compare_results(rows)
    assert _partitions(many) == 60 and _partitions(few) < 60
    assert sorted(map(tuple, many.collect())) == [(q, True, 4, 4) for q in range(75)]
    large = ev.compare_results(rows.withColumn("query_id", F.lit(None).cast("bigint")))  # one group, null
    assert [tuple(r) for r in large.collect()] == [(None, True, 300, 300)]


def test_slices_are_tasks_of_their_own(spark):
    df = spark.range(2000).select(F.lit(1).alias("g"), ((F.col("id") * 7) % 2000).alias("o"))
    out = ordering.positions_within(df, ["g"], ["o"], rows=20)
    assert sorted((r["o"], r["pos"]) for r in out.collect()) == [(i, i + 1) for i in range(2000)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    parts = len(ordering.slice_bounds(df, ["g"], ["o"], 20)) + 1
    assert parts > 50 and f", {parts}), REPARTITION_BY_NUM" in plan


def test_batches_of_wide_rows_are_spread(spark, monkeypatch):
    monkeypatch.setattr(TR, "WIDE_ROWS", 20)
    ids = F.transform(F.sequence(F.lit(0), (F.col("id") % 5).cast("int")), lambda x: x + 7)
    df = TR.training_rows(spark.range(1999).select((F.col("id") * 3).alias("ord"), ids.alias("token_ids")))
    out = TR.pad_batches(TR.batch_ids(df, 8))
    assert _partitions(out) == 100
    got = {r["ord"] // 3: r for r in out.collect()}
    for i in range(1999):
        longest = max(j % 5 + 1 for j in range(i // 8 * 8, min(1999, i // 8 * 8 + 8)))
        assert got[i]["batch"] == i // 8 and got[i]["n_pad"] == longest - (i % 5 + 1)
        assert got[i]["labels"] == got[i]["token_ids"] + [TR.LABEL_PAD] * got[i]["n_pad"]
