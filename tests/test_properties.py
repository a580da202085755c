"""Property tests from the test strategy: export then parse is the identity on
stripped non-blank pairs; SQL normalisation is idempotent."""
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sqlmill.functions.sqltext import normalize_sql
from sqlmill.operators import catalog as cat
from sqlmill.operators import parse as P
from sqlmill.session import scratch_path
from sqlmill.sinks import writers as W
from sqlmill.sources import files as S

text = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), min_size=1, max_size=40).map(str.strip).filter(bool)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(text, text), min_size=1, max_size=8))
def test_export_then_parse_is_identity(spark, pairs):
    df = spark.createDataFrame(pairs, "input string, output string")
    path = scratch_path(spark, "t-prop-sharegpt")
    W.export(df, path, "sharegpt")
    back = P.parse_sharegpt(S.scan_jsonl(spark, path, "conversations array<struct<role:string,content:string>>"),
                            keys=())
    assert sorted(map(tuple, back.collect())) == sorted(pairs)


sqlish = st.lists(st.sampled_from(["SELECT", "select", "a", "FROM", "t", " ", "\n", "　", "'x  y'", "-- c\n",
                                   "/* k */", "(", ")", ",", "Where", "éé", "1"]), max_size=15).map("".join)


@settings(max_examples=10, deadline=None)
@given(st.lists(sqlish, min_size=1, max_size=6))
def test_normalize_is_idempotent(spark, sqls):
    df = spark.createDataFrame([(s,) for s in sqls], "v string")
    once = [r[0] for r in df.select(normalize_sql("v")).collect()]
    df2 = spark.createDataFrame([(s,) for s in once], "v string")
    twice = [r[0] for r in df2.select(normalize_sql("v")).collect()]
    assert once == twice


def test_jdbc_rejects_unknown_database_type(spark):
    with pytest.raises(ValueError):
        cat.read_catalog_jdbc(spark, "jdbc:none://x", ["db"], {}, db_type="sqlserver")
