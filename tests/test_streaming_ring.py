"""The log ring as a stateful stream: late lines, a restart, ended runs."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sqlmill.operators import runs as R
from sqlmill.streaming import log_ring as L

SCHEMA = "run_id long, ts timestamp_ntz, seq long, message string"


@pytest.fixture
def rocks(spark):
    new = {L.PROVIDER_KEY: L.PROVIDER, "spark.sql.shuffle.partitions": "2"}
    old = {k: spark.conf.get(k) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def lines(n, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([1, 1, 1, 2, 3]), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(n)), i, f"line {i}") for i in range(n)]
    rng.shuffle(rows)  # lines arrive out of order
    return rows


def drain(spark, folder, check, n, keep=None, ended=None):
    """Runs the stream over what is new in the folder; all rings emitted, by run, each as a sorted list."""
    rings = {}

    def take(df, batch):
        for r in df.collect():
            rings.setdefault(r["run_id"], []).append((r["rank"], r["seq"], r["message"]))
    log = spark.readStream.schema(SCHEMA).parquet(folder)
    q = (L.stream_latest_logs(log, n, keep, ended).writeStream.foreachBatch(take).outputMode("update")
         .option("checkpointLocation", check).trigger(availableNow=True).start())
    assert q.awaitTermination(60)
    return {k: sorted(v) for k, v in rings.items()}


def put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_ring_equals_the_batch_query_with_late_lines_and_a_restart(spark, rocks, tmp_path):
    folder, check = str(tmp_path / "in"), str(tmp_path / "check")
    rows = lines(240, 4)
    put(spark, folder, rows[:160])
    got = drain(spark, folder, check, 7)
    put(spark, folder, rows[160:] + rows[:20])  # after the restart: late lines, and lines that came before
    got.update(drain(spark, folder, check, 7))
    want = {}
    for r in R.latest_logs(spark.createDataFrame(rows, SCHEMA), n=7).collect():
        want.setdefault(r["run_id"], []).append((r["rank"], r["seq"], r["message"]))
    assert got == {k: sorted(v) for k, v in want.items()}


def test_an_ended_run_is_dropped_after_a_while(spark, rocks, tmp_path):
    folder, check = str(tmp_path / "in"), str(tmp_path / "check")
    t = dt.datetime(2024, 1, 1)
    put(spark, folder, [(1, t, 1, "a"), (1, t, 2, "done"), (2, t, 1, "b")])
    ended = F.col("message") == "done"
    first = drain(spark, folder, check, 5, "1 minute", ended)
    assert [m for _, _, m in first[1]] == ["done", "a"]
    hour = dt.timedelta(hours=1)
    put(spark, folder, [(2, t + hour, 2, "c")])
    drain(spark, folder, check, 5, "1 minute", ended)  # time has passed the end of run 1
    put(spark, folder, [(1, t + hour, 3, "new"), (2, t + hour, 3, "d")])
    last = drain(spark, folder, check, 5, "1 minute", ended)
    assert [m for _, _, m in last[1]] == ["new"] and [m for _, _, m in last[2]] == ["d", "c", "b"]
