"""Tokens are walked along by batches: the same rows whatever the batches, and no expression per token."""
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF
from sqlmill.functions.text import sql_lex, sql_pieces
from sqlmill.operators import binding, walk
from sqlmill.operators import validation as V
from sqlmill.sources import fixtures

Q = E.queries()


def _samples(spark, rows):
    return spark.createDataFrame(rows, "sample_id long, db_id long, output string")


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("key", ["check_syntax", "table_refs", "column_refs", "resolve_aliases"])
def test_queries_have_no_lambdas_along_the_tokens(spark, key):
    p = _plan(Q[key](spark, SF))
    assert p.count("MapInArrow") == 1 and p.count("lambdafunction") < 10


@pytest.mark.parametrize("made", [V.statement_summary, binding.binding_summary])
def test_stored_summaries_have_no_lambdas_along_the_tokens(spark, made):
    p = _plan(made(fixtures.samples(spark, SF)))
    assert p.count("MapInArrow") == 1 and p.count("lambdafunction") < 10


TEXTS = [["SELECT ", "a.", "b ", "FROM ", "t ", "a"], [], ["(", "SELECT ", "1", ")", ";"], ["-- x\n", "SELECT ", "1"]]


def test_rows_do_not_depend_on_the_parts_of_a_batch(monkeypatch):
    lexed = pa.array([[x] for x in TEXTS] + [TEXTS[:1] * 2, []], pa.list_(pa.list_(pa.string())))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(lexed))), lexed], names=["k", "lexed"])

    def rows(size):
        monkeypatch.setattr(walk, "TOKENS", size)
        parts = [(p.column(0).to_pylist(), [c.to_pylist() for c in binding._bindings(V.Rules(p.column(1))) + V._summarised(V.Rules(p.column(1)))])
                 for p in walk._parts(batch, 1)]
        return len(parts), [(k, *r) for ks, columns in parts for k, r in zip(ks, zip(*columns))]
    whole, single = rows(1 << 19), rows(1)
    assert whole[0] == 1 and single[0] >= 4
    assert repr(whole[1]) == repr(single[1]) and [r[0] for r in whole[1]] == list(range(len(lexed)))
    assert rows(8)[1] == whole[1]


def test_pieces_are_the_tokens(spark):
    texts = ["SELECT  a\t.　b -- c  \n\n /* d */ FROM 'it''s ' , \"q \" ' x", "", "a", "--", "-- b", "a--\n\nb /*", "` `\n`", "中 €é→ 1"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(sql_lex("t").alias("l"), sql_pieces("t").alias("p")).collect()
    for r in got:
        assert "".join(r["l"]) == "".join(r["p"])
        assert [walk._bare(p) for p in r["p"]] == [t for t in r["l"] if not t.isspace()]


def test_names_and_words_beyond_ascii(spark):
    rows = [(1, 0, 'ſELECT x."İx" FROM İstanbul x, "Ä b" AS `ΣΑΣ`, 中文 é'), (2, 0, "SELECT €, 1 FROM t →"), (3, 0, "SELECT a FROM " + " " * 5 + "b -- FROM c\n, d")]
    frame = V.token_frame(V.sql_tokens(_samples(spark, rows)))
    refs = sorted((r["sample_id"], r["pos"], r["table_name"], r["alias"]) for r in V.table_refs(frame).collect())
    assert [r[2:] for r in refs if r[0] == 1] == [("i̇stanbul", "x"), ("ä b", "σας"), ("中文", "é")]
    assert [r[2:] for r in refs if r[0] == 2] == [("t", None)]
    assert [r[1:] for r in refs if r[0] == 3] == [(6, "b", None), (12, "d", None)]
    assert [r[1:] for r in V.column_refs(frame).select("sample_id", "qualifier", "column_name").collect()] == [("x", "i̇x")]
    assert {r["tok"] for r in frame.where("is_id and sample_id = 2").collect()} == {"t"}


def test_texts_of_one_key_are_one_statement_in_order_of_position(spark):
    rows = [(1, 0, "SELECT a.x FROM t a"), (1, 1, "UPDATE u SET y = 1"), (1, 0, None)]
    s = _samples(spark, rows)
    tokens = [r["tok"] for r in V.sql_tokens(s).orderBy("pos", "_i", "tok").collect()]
    assert tokens == ["SELECT", "UPDATE", "a", "u", ".", "SET", "x", "y", "FROM", "=", "t", "1", "a"]
    got = V.statement_summary(s).collect()
    assert len(got) == 1 and got[0]["blank"] and got[0]["n_tokens"] == 13
    assert [(t["pos"], t["table_name"], t["alias"]) for t in got[0]["trefs"]] == [(2, "u", None), (8, "t", "a")]


def test_a_frame_has_only_the_fields_asked_for(spark):
    s = _samples(spark, [(1, 0, "SELECT a FROM t"), (2, 0, " ")])
    assert V.sql_tokens(s, fields=("tref",)).columns == ["sample_id", "db_id", "blank", "pos", "cum", "tref"]
    assert V.sql_tokens(s, fields=("tref",), outer=True).where(F.col("pos").isNull()).select("sample_id").collect()[0][0] == 2
    assert set(V.TOKEN) < set(V.sql_tokens(s).columns)
