"""Functions, a template and a rule used from SQL alone equal the column forms."""
import pytest
from pyspark.sql import functions as F

from conftest import SF
from sqlmill.functions import extend
from sqlmill.functions.sqltext import limit_probe_sql, normalize_sql, select_gate
from sqlmill.operators import evaluation as ev
from sqlmill.operators import validation as V
from sqlmill.sources import fixtures


def test_sql_functions_equal_the_column_forms(spark):
    extend.register_functions(spark)
    pairs = fixtures.prediction_pairs(spark, SF)
    extra = spark.createDataFrame([(0, 99991, "q", "SELECT 'it''s \\\\' -- x\n FROM \"T\"  ;", " select 1"), (0, 99992, "q", "", "é"),
                                   (0, 99993, "q", None, "a")], "run_id long, ord long, question string, prediction string, reference string")
    pairs = pairs.unionByName(extra)
    pairs.createOrReplaceTempView("extend_pairs")
    got = spark.sql("""select ord, normalize_sql(prediction) n, select_gate(prediction) g, limit_probe_sql(prediction) p,
                       token_f1(prediction, reference) f1 from extend_pairs""").collect()
    want = ev.with_token_f1(pairs).select("ord", normalize_sql("prediction").alias("n"), select_gate("prediction").alias("g"),
                                          limit_probe_sql("prediction").alias("p"), "f1").collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) > 1000


def test_a_template_and_a_rule_from_sql(spark):
    assert extend.register_template(spark, "ask", "Schema {{{db}}}:\n{ddl}\nQ: {question} ({db}, it's)") == ["db", "ddl", "question"]
    row = spark.sql("select ask('shop', null, 'how many?') as p").first()
    assert row["p"] == "Schema {shop}:\n\nQ: how many? (shop, it's)"
    extend.register_rule(spark, "no_star", "contains(upper(sql), 'SELECT *')", "name the columns, don't use *")
    assert spark.sql("select no_star('select * from t') a, no_star('select a from t') b").first() == ("name the columns, don't use *", None)
    samples = spark.createDataFrame([(1, 0, "SELECT * FROM orders"), (2, 0, "SELECT o_custkey FROM orders"), (3, 0, "SELECT * FROM nope")],
                                    "sample_id long, db_id long, output string")
    cat = spark.createDataFrame([(0, "orders", "o_custkey")], "db_id long, table_name string, column_name string")
    out = {r["sample_id"]: (r["error_kind"], r["error"]) for r in V.validate_samples(samples, cat, rules=(extend.rule("no_star"),)).collect()}
    assert out[1] == ("no_star", "name the columns, don't use *") and out[2] == (None, None) and out[3][0] == "missing_table"
    with pytest.raises(ValueError):
        extend.register_rule(spark, "bad name(", "true", "x")
