"""Every registered query against its DuckDB oracle on sf0.001, plus
partition-count invariance on a sample of queries."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF
from sqlmill.sources.tables import TABLES

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def canon(v):
    if v is None:
        return ("~",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, float)):
        return ("n", "nan") if isinstance(v, float) and math.isnan(v) else ("n", float(f"{float(v):.9g}"))
    return ("s", str(v))


def rows_of(cols, rows):
    order = sorted(cols)
    idx = [cols.index(c) for c in order]
    return order, sorted(tuple(canon(r[i]) for i in idx) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "total_samples" in df.columns


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF)
    rows = df.collect()
    if key not in ORACLE:
        assert len(rows) >= 0
        return
    rel = duck.sql(ORACLE[key])
    assert rows_of(df.columns, rows) == rows_of(rel.columns, rel.fetchall())


@pytest.mark.parametrize("key", ["validate_samples", "compare_results", "allocate_samples", "early_stopping"])
def test_partition_count_invariance(spark, key):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = QUERIES[key](spark, SF)
        ra = rows_of(a.columns, a.collect())
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        b = QUERIES[key](spark, SF)
        assert ra == rows_of(b.columns, b.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
