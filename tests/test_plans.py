"""Physical-plan properties the design relies on at scale."""
import re

import __spark_entry__ as E
from conftest import SF
from sqlmill.operators import validation as V
from sqlmill.sources import fixtures

Q = E.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_needed_columns(spark):
    p = plan(Q["avg_token_f1"](spark, SF))
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", p):
        assert "lang" not in schema and "n_chars" not in schema


def test_aggregations_are_partial(spark):
    for key in ("dataset_stats", "text_metrics", "execution_rates", "throughput_stats"):
        p = plan(Q[key](spark, SF))
        assert "partial_" in p, key


def test_top_k_is_limited_before_the_shuffle(spark):
    p = plan(Q["latest_logs"](spark, SF))
    assert p.count("WindowGroupLimit") >= 2


def test_token_windows_reuse_one_shuffle(spark):
    frame = V.token_frame(V.sql_tokens(fixtures.samples(spark, SF)))
    p = plan(frame)
    assert p.count("Exchange hashpartitioning(sample_id") == 1


def test_text_paths_have_no_python_udf(spark):
    for key in ("avg_token_f1", "normalize_sql", "validate_samples", "extract_sql", "extract_json"):
        p = plan(Q[key](spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p, key


def test_no_cross_joins_or_row_udfs_anywhere(spark):
    """No registered query plans a cartesian product, a nested-loop join or a
    row-at-a-time Python UDF."""
    bad = {}
    for key, fn in Q.items():
        p = plan(fn(spark, SF))
        hits = [op for op in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython") if op in p]
        if hits:
            bad[key] = hits
    assert bad == {}


def test_statements_are_lexed_once(spark):
    for key in ("sql_tokens", "check_syntax", "table_refs", "column_refs", "resolve_aliases"):
        df = Q[key](spark, SF)
        lexers = df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all")
        assert lexers == 1, (key, lexers)
