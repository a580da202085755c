"""Metrics, result comparison, execution of distinct SQL texts, streaming."""
import re
import shutil
import tempfile

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sqlmill.operators import evaluation as ev
from sqlmill.operators import execution as X


def f1_of(spark, pairs):
    df = spark.createDataFrame(pairs, "prediction string, reference string")
    return [r[0] for r in df.select(ev.token_f1_col()).collect()]


def test_token_f1_hand_cases(spark):
    got = f1_of(spark, [("SELECT a FROM t", "select a from t"), ("", "x"), ("a b", "c d"), ("a b c d", "a b")])
    assert got[0] == 1.0 and got[1] == 0.0 and got[2] == 0.0
    assert abs(got[3] - (2 * 0.5 * 1.0 / 1.5)) < 1e-15


words = st.lists(st.sampled_from(["select", "a", "b", "from", "t", "É", "x1", "_"]), max_size=6).map(" ".join)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(words, words), min_size=1, max_size=5))
def test_token_f1_symmetric_and_bounded(spark, pairs):
    a = f1_of(spark, pairs)
    b = f1_of(spark, [(r, p) for p, r in pairs])
    for x, y, (p, r) in zip(a, b, pairs):
        assert 0.0 <= x <= 1.0 and abs(x - y) < 1e-12
        if not re.findall(r"\w+", p) or not re.findall(r"\w+", r):
            assert x == 0.0


def compare(spark, rows, ordered=True):
    df = spark.createDataFrame(rows, "query_id long, side string, row_idx long, cells array<string>")
    return {r["query_id"]: r["rows_equal"] for r in ev.compare_results(df, ordered).collect()}


def test_compare_results_edges(spark):
    rows = [
        (1, "ref", 1, ["a", None]), (1, "pred", 5, ["a", None]),              # NULL = NULL, positions renumbered
        (2, "ref", 1, ["1"]), (2, "pred", 1, ["1", "2"]),                     # arity differs
        (3, "ref", 1, [ev.NAN_MARK]), (3, "pred", 1, [ev.NAN_MARK]),          # NaN never equal
        (4, "ref", 1, ["x"]), (4, "ref", 2, ["y"]), (4, "pred", 1, ["y"]), (4, "pred", 2, ["x"]),  # order
        (5, "ref", 1, ["x"]), (5, "ref", 2, ["x"]), (5, "pred", 1, ["x"]),    # duplicate rows
    ]
    assert compare(spark, rows) == {1: True, 2: False, 3: False, 4: False, 5: False}
    assert compare(spark, rows, ordered=False) == {1: True, 2: False, 3: False, 4: True, 5: False}


def test_execute_distinct(spark):
    for t in ("nation", "region"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").createOrReplaceTempView(t)
    qs = spark.createDataFrame([
        (1, "ref", "SELECT n_name, n_regionkey FROM nation ORDER BY n_nationkey"),
        (1, "pred", "SELECT n_name, n_regionkey * 1.0 FROM nation ORDER BY n_nationkey"),
        (2, "ref", "SELECT COUNT(*) FROM region"), (2, "pred", "SELECT COUNT(*) FROM nope"),
        (3, "ref", "WITH x AS (SELECT 1) SELECT * FROM x"),
        (3, "pred", "SELECT n_name, n_regionkey FROM nation ORDER BY n_nationkey")],
        "query_id long, side string, sql string")
    status, results = X.execute_distinct(spark, qs)
    assert status.count() == 5                      # duplicate text ran once
    ex, rows = X.execution_rows(qs, status, results)
    d = {r["query_id"]: r for r in ev.execution_details(ex, ev.compare_results(rows)).collect()}
    assert d[1]["results_match"] and d[1]["reference_result_count"] == 25
    assert not d[2]["prediction_executed"] and "nope" in d[2]["prediction_error"]
    assert not d[3]["reference_executed"] and d[3]["reference_error"] == X.E_GATE


def test_streaming_run_status_equals_batch(spark):
    from sqlmill.operators import runs as R
    from sqlmill.streaming import stream_ops as P
    d = tempfile.mkdtemp(prefix="evstream-")
    shutil.copy("/root/testdata/sf0.001/events.parquet", d + "/events.parquet")
    q = P.start(P.stream_run_status(P.read_events(spark, d)), "run_status_test", mode="complete")
    q.processAllAvailable()
    q.stop()
    got = spark.sql("select * from run_status_test")
    ev_ = spark.read.parquet(d).selectExpr("user_id as run_id", "ts", "event_id as seq", "event_type",
                                           "event_id % 6 + 1 as step")
    batch = R.run_status(ev_)
    assert got.count() == batch.count() and got.exceptAll(batch).count() == 0


def counting_model(prompts):
    if any("bad" in p for p in prompts):
        raise RuntimeError("boom")
    return [f"answer to {p}" for p in prompts]


def test_cached_inference_calls_each_prompt_once(spark):
    from sqlmill.operators import generation as G
    from sqlmill.session import scratch_path
    cache = scratch_path(spark, "t-cache")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "bad")], "id long, prompt string")
    out = {r["id"]: (r["response"], r["error"]) for r in
           G.cached_inference(df, counting_model, cache, keys=("id",), base_wait=0.0, max_retries=1).collect()}
    assert out[1] == ("answer to a", None) and out[3] == ("answer to a", None)
    assert out[4][0] is None and "boom" in out[4][1]
    stored = spark.read.parquet(cache)
    assert stored.count() == 2                       # 'a' once, 'b' once; the failure is not stored
    df2 = spark.createDataFrame([(5, "a"), (6, "c")], "id long, prompt string")
    G.cached_inference(df2, counting_model, cache, keys=("id",), base_wait=0.0).collect()
    assert spark.read.parquet(cache).count() == 3    # only 'c' was new


def test_typed_cells(spark):
    rows = spark.sql("""select '1' as s, 1 as i, 1.0D as d, cast(1.00 as decimal(5,2)) as m, true as b, date'2020-01-01' as dt, '2020-01-01' as ds,
        double('infinity') as inf, 1e30D as big, 1e-13D as small, 0D as zero, double('nan') as nan, cast(null as int) as nul,
        cast(0.1 as decimal(3,1)) as tenth, 0.1D as dtenth, cast(1.5 as decimal(4,1)) as half, 1.5D as dhalf, X'01' as raw""")
    c = dict(zip(rows.columns, X.canonical_cells(rows).collect()[0]["cells"]))
    assert c["i"] == c["d"] == c["m"] == c["b"] and c["s"] != c["i"]
    assert c["dt"] != c["ds"] and c["nul"] is None
    assert len({c["inf"], c["big"], c["small"], c["zero"]}) == 4 and c["inf"] is not None
    assert c["nan"] == X.NAN_MARK
    assert c["tenth"] != c["dtenth"] and c["half"] == c["dhalf"]


def test_tries_are_counted_per_row():
    from sqlmill.operators import generation as G
    sent = []

    def model(prompts):
        sent.extend(prompts)
        return counting_model(prompts)
    answers, errors, tries = G._call_with_retries(model, ["a", "bad", "c"], 3, 0.0)
    assert answers == ["answer to a", None, "answer to c"] and tries == [2, 3, 2]
    assert errors[0] is None and "boom" in errors[1]
    assert sent.count("bad") == 3 and sent.count("a") == 2

    flaky = {"n": 0}

    def json_at_last(prompts):
        flaky["n"] += 1
        return ["not json"] if flaky["n"] == 1 else ['```json\n{"a": 1}\n```']
    G.must_be_json('{"topics":[{"reason":"use ```sql x``` here"}]}')  # valid as a whole, fences inside
    answers, errors, tries = G._call_with_retries(json_at_last, ["p"], 3, 0.0, accept=G.must_be_json)
    assert tries == [2] and errors == [None] and "```json" in answers[0]
    assert G._is_timeout(RuntimeError("Request timed out.")) and not G._is_timeout(ValueError("x"))
    import time
    _, errors, _ = G._call_with_retries(lambda p: time.sleep(5), ["p"], 1, 0.0, limit_s=0.1)
    assert "timed out" in errors[0]


def test_batches_are_full(spark):
    from sqlmill.operators import training as TR
    df = spark.createDataFrame([(i * 7 + i % 3,) for i in range(1000)], "ord long")
    sizes = sorted(r["count"] for r in TR.batch_ids(df, 8).groupBy("batch").count().collect())
    assert sizes == [8] * 125


def test_positions_in_many_slices_and_min_delta(spark):
    import random
    from sqlmill.operators import ordering, training as TR
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "a", "b"]), rng.randrange(10 ** 6) ** 2, rng.random()) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, o long, x double")
    got = ordering.positions_within(df, ["k"], ["o"], rows=100).collect()
    for k in ("hot", "a", "b"):
        own = sorted((r["o"], r["pos"]) for r in got if r["k"] == k)
        assert [p for _, p in own] == list(range(1, len(own) + 1))
    run = ordering.running(df, ["k"], ["o"], "x", "min", "m", rows=100).collect()
    own = sorted((r["o"], r["x"], r["m"]) for r in run if r["k"] == "hot")
    assert all(m == min(x for _, x, _ in own[:i + 1]) for i, (_, _, m) in enumerate(own))
    losses = [1.0, 0.95, 0.94, 0.93, 0.5, 0.49]
    h = spark.createDataFrame([(1, i + 1, x) for i, x in enumerate(losses)], "run_id long, epoch int, loss double")
    r = TR.early_stopping(h, 3, min_delta=0.1).collect()[0]
    assert (r["stop_epoch"], r["best_loss"], r["best_epoch"]) == (4, 1.0, 1)
    assert TR.early_stopping(h, 3).collect()[0]["stop_epoch"] is None


def test_extract_sql_is_linear_in_lines(spark):
    import time
    from pyspark.sql import functions as F
    from sqlmill.functions.sqltext import extract_sql

    def took(n):
        text = "\n".join(["prose line"] * n + ["select 1", "from t;"] + ["more"] * n)
        df = spark.createDataFrame([(text,)], "v string")
        t0 = time.time()
        assert df.select(extract_sql("v")).collect()[0][0] == "select 1 from t;"
        return time.time() - t0
    took(10)
    assert took(20_000) < 20 * max(took(2_000), 0.2)


def test_slices_only_where_a_group_is_large(spark):
    from pyspark.sql import functions as F
    from sqlmill.operators import ordering
    rows = spark.range(1000).select((F.col("id") % 10).alias("g"), F.col("id").alias("x"))
    assert ordering.slice_bounds(rows, ["g"], ["x"], rows=100) == []
    hot = rows.unionByName(spark.range(400).select(F.lit(3).cast("long").alias("g"), (F.col("id") * 3 + 5000).alias("x")))
    bounds = ordering.slice_bounds(hot, ["g"], ["x"], rows=100)
    assert len(bounds) > 5
    a = ordering.positions_within(hot, ["g"], ["x"], rows=100).collect()
    b = ordering.positions_within(hot, ["g"], ["x"], rows=100_000).collect()
    assert sorted(a) == sorted(b)


def test_neighbours_equal_the_joined_pairs(spark):
    from pyspark.sql import functions as F
    from sqlmill.operators import evaluation as ev
    docs = spark.createDataFrame([(1, "a b c"), (2, "b c d"), (3, ""), (4, None), (5, "x y"), (6, "X"), (9, "z"), (None, "b")], "doc_id long, text string")
    docs = docs.withColumn("run_id", F.lit("r"))
    nxt = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("reference"))
    joined = docs.join(nxt, "doc_id").withColumnRenamed("text", "prediction")
    assert ev.neighbour_f1(docs, "doc_id").collect() == ev.avg_token_f1(joined).collect()
