"""The bound on simultaneous model calls (G1) and early stopping by chained slices (A10)."""
import os
import time
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from sqlmill.operators import generation as G
from sqlmill.operators import training as TR


def most_at_once(folder):
    events = []
    for name in os.listdir(folder):
        start, end = map(float, open(os.path.join(folder, name)).read().split())
        events += [(start, 1), (end, -1)]
    running = most = 0
    for _, step in sorted(events):
        running += step
        most = max(most, running)
    return most, len(events) // 2


def slow_model(folder, seconds):
    def call(prompts):
        start = time.time()
        time.sleep(seconds)
        with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write(f"{start} {time.time()}")
        return [p.upper() for p in prompts]
    return call


@pytest.mark.parametrize("concurrency,window,least", [(4, 2, 3), (3, 3, 3), (2, 1, 2)])
def test_calls_at_once_are_bounded_and_answers_keep_their_order(spark, tmp_path, concurrency, window, least):
    prompts = spark.range(60).select("id", F.concat(F.lit("p"), F.col("id")).alias("prompt")).repartition(20)
    out = G.batch_inference(prompts, slow_model(str(tmp_path), 0.05), batch_size=2, concurrency=concurrency, window=window).collect()
    assert {r["id"]: r["response"] for r in out} == {i: f"P{i}" for i in range(60)}
    most, calls = most_at_once(tmp_path)
    assert least <= most <= concurrency and calls >= 30


def test_a_call_out_of_time_keeps_its_slot(spark, tmp_path):
    prompts = spark.range(4).select("id", F.lit("p").alias("prompt")).coalesce(1)
    out = G.batch_inference(prompts, slow_model(str(tmp_path), 0.6), batch_size=4, concurrency=1, max_retries=2, base_wait=0.0, limit_s=0.25).collect()
    assert all("TimeoutError" in r["error"] for r in out)
    time.sleep(1.5)
    assert most_at_once(tmp_path)[0] == 1
    with pytest.raises(ValueError):
        G.batch_inference(prompts, slow_model(str(tmp_path), 0), concurrency=2, window=3)


def fold(epochs, losses, patience, delta):
    best, at, waited = None, None, 0
    for e, x in zip(epochs, losses):
        if best is None or x < best - delta:
            best, at, waited = x, e, 0
        else:
            waited += 1
            if waited >= patience:
                return e, e, best, at
    return None, epochs[-1], best, at


def test_chained_slices_equal_the_fold(spark, monkeypatch):
    monkeypatch.setattr(TR, "SLICE_EPOCHS", 16)
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for run in range(40):
        n, patience = int(rng.integers(1, 120)), 3
        epochs = np.cumsum(rng.integers(1, 4, n)).tolist()
        fall = rng.choice([0.0, 0.02, 0.2])
        losses = (10 - fall * np.arange(n) + rng.normal(0, 0.3, n)).round(3).tolist()
        rows += [(run, e, x) for e, x in zip(epochs, losses)]
        want[run] = fold(epochs, losses, patience, 0.05)
    df = spark.createDataFrame(rows, "run_id long, epoch int, loss double").repartition(5)
    got = {r["run_id"]: tuple(r)[1:] for r in TR.early_stopping(df, 3, min_delta=0.05).collect()}
    assert got == want


def test_one_run_of_a_million_epochs(spark):
    n = 1_000_000
    noise = (F.xxhash64("id") % 1000) / 1000.0
    df = spark.range(n).select(F.lit(1).alias("run_id"), (F.col("id") + 1).alias("epoch"), (1e6 - F.col("id") * 0.5 + noise).alias("loss"))
    late = df.withColumn("loss", F.when(F.col("epoch") > 900_000, F.lit(5e6)).otherwise(F.col("loss")))
    data = late.orderBy("epoch").toPandas()
    for patience in (5, 40):
        out = TR.early_stopping(late, patience, min_delta=1.0)
        assert [tuple(r)[1:] for r in out.collect()] == [fold(data["epoch"].tolist(), data["loss"].tolist(), patience, 1.0)]
