"""Tokens stay in their statement's row: none is sorted, and long statements are carried by pieces."""
import pytest
from sqlmill.operators import binding
from sqlmill.operators import validation as V


def _samples(spark, rows):
    return spark.createDataFrame(rows, "sample_id long, db_id long, output string")


@pytest.mark.parametrize("name", ["check_syntax", "table_refs", "resolve_aliases", "binding_summary"])
def test_only_samples_are_sorted(spark, name):
    samples = _samples(spark, [(1, 0, "SELECT 1")])
    df = {"resolve_aliases": lambda: V.resolve_aliases(V.statement_summary(samples, carry=False)),
          "binding_summary": lambda: binding.binding_summary(samples)}.get(
              name, lambda: getattr(V, name)(V.token_frame(V.sql_tokens(samples))))()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Window [") == 1
    assert plan.index("Generate") < plan.index("Sort [")  # below the tokens


def test_long_and_repeated_statements(spark):
    n = 150
    long = "SELECT " + ", ".join(f"(SELECT t{i}.a FROM s{i} AS t{i})" for i in range(n)) + " FROM z, y"
    rows = [(1, 0, long), (2, 0, "SELECT a.x FROM b a"), (2, 0, "SELECT a.x FROM b a"), (None, 0, "SELECT (1"), (3, 0, None)]
    frame = V.token_frame(V.sql_tokens(_samples(spark, rows)))
    refs = sorted((r["sample_id"], r["pos"], r["table_name"], r["alias"]) for r in V.table_refs(frame).collect())
    assert [r[2:] for r in refs if r[0] == 1] == [(f"s{i}", f"t{i}") for i in range(n)] + [("z", None), ("y", None)]
    assert [r[2:] for r in refs if r[0] == 2] == [("b", "a")] * 2
    assert [(r["sample_id"], r["message"]) for r in V.check_syntax(frame).collect()] == [(None, V.MSG_SYNTAX + "unbalanced parentheses")]
