"""Run SQL texts on Spark itself and keep their result rows for comparison.

Each *distinct* text runs once (the reference re-runs duplicates and runs each
prediction twice).  Texts must pass the SELECT gate (F3).  A time limit is
enforced by interrupting the statement's jobs through a session tag.  Result
rows are written in canonical text form to a table in the shared folder —
they never pass through the driver; only the list of distinct texts is
streamed to it (``toLocalIterator``), one Spark job per text, because every
statement is its own plan.  The comparison (J10) and the rates (E4–E6) are
then ordinary joins over the written tables.
"""

from __future__ import annotations

import threading
import uuid
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sqltext import select_gate
from ..session import scratch_path
from .evaluation import NAN_MARK

E_GATE = "只允许执行 SELECT 查询"   # fixed value: only SELECT statements may run


def _double_text(d):
    whole = (d == F.floor(d)) & (F.abs(d) < 2.0 ** 53)
    return F.when(whole, d.cast("bigint").cast("string")).otherwise(d.cast("string"))


def canonical_cell(c, kind: T.DataType):
    """One value as tagged text that is equal exactly where Python's values are:
    ``n:`` numbers by value (1 = 1.0 = true), ``s:`` strings, ``d:`` dates,
    ``t:`` timestamps, ``b:`` bytes, ``x:`` the rest; NaN is a mark that equals
    nothing, NULL stays NULL.

    Whole numbers below 2^53 are written as integers, other doubles by their
    shortest digits, which are unique per value.  Longs and decimals that some
    double equals are written as that double, all others as ``n:=`` digits."""
    if isinstance(kind, T.BooleanType):
        return F.concat(F.lit("n:"), c.cast("int").cast("string"))
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        c, kind = c.cast("decimal(20,0)"), T.DecimalType(20, 0)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        d = c.cast("double")
        return F.when(F.isnan(d), F.lit(NAN_MARK)).otherwise(F.concat(F.lit("n:"), _double_text(d)))
    if isinstance(kind, T.DecimalType):
        plain = c.cast("string")
        bare = F.when(plain.contains("."), F.regexp_replace(F.regexp_replace(plain, r"0+$", ""), r"\.$", "")).otherwise(plain)
        d = c.cast("double")
        # some double has this very value: multiplied by a power of two it is whole, and it reads back equal
        whole = (c * F.lit(Decimal(1 << min(kind.scale, 18)))) % 1 == 0
        exact = F.coalesce(whole & (d.cast(kind) == c), F.lit(False))
        return F.concat(F.lit("n:"), F.when(exact, _double_text(d)).otherwise(F.concat(F.lit("="), bare)))
    tag = {T.StringType: "s:", T.DateType: "d:", T.TimestampType: "t:", T.TimestampNTZType: "t:", T.BinaryType: "b:"}.get(type(kind), "x:")
    text = F.hex(c) if isinstance(kind, T.BinaryType) else c.cast("string")
    return F.concat(F.lit(tag), text)


def canonical_cells(df: DataFrame) -> DataFrame:
    """One ``array<string>`` of canonical cells per row."""
    cells = [canonical_cell(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    return df.select((F.array(*cells) if cells else F.array().cast("array<string>")).alias("cells"))


RAW_SCHEMA = "sql_hash string, _m bigint, cells array<string>"


def _run_one(spark: SparkSession, sql: str, timeout_s: float, out: str, sql_hash_value: str):
    """Run one statement and append its rows; ``_m`` keeps the output order
    (partition, position), made dense later for all statements at once."""
    tag = f"x1-{uuid.uuid4().hex}"
    spark.addTag(tag)
    timer = threading.Timer(timeout_s, lambda: spark.interruptTag(tag))
    timer.start()
    try:
        res = canonical_cells(spark.sql(sql))
        (res.select(F.lit(sql_hash_value).alias("sql_hash"), F.monotonically_increasing_id().alias("_m"), "cells")
            .write.mode("append").parquet(out))
        return True, None
    except Exception as e:  # noqa: BLE001 - any SQL or runtime error is a result
        return False, f"{type(e).__name__}: {e}"
    finally:
        timer.cancel()
        spark.removeTag(tag)


def execute_distinct(spark: SparkSession, queries: DataFrame, sql="sql", timeout_s: float = 5.0,
                     results_path: str | None = None):
    """(status, results): ``status`` = (sql_hash, exec_ok, error, n_rows) per
    distinct text, ``results`` = (sql_hash, row_idx, cells).  Join either back
    to ``queries`` on ``sql_hash(sql)``.  Views the statements use must be
    registered in the session beforehand."""
    from .ordering import positions_within
    out = results_path or scratch_path(spark, "x1-results")
    spark.createDataFrame([], RAW_SCHEMA).write.mode("overwrite").parquet(out)
    texts = queries.select(F.col(sql).alias("sql")).distinct().select("sql", sql_hash("sql").alias("h"),
                                                                       select_gate("sql").alias("ok"))
    status = []
    for row in texts.toLocalIterator():
        if not row["ok"]:
            status.append((row["h"], False, E_GATE))
            continue
        ok, err = _run_one(spark, row["sql"], timeout_s, out, row["h"])
        status.append((row["h"], ok, err))
    st_path = scratch_path(spark, "x1-status")
    spark.createDataFrame(status, "sql_hash string, exec_ok boolean, error string").write.parquet(st_path)
    results = positions_within(spark.read.parquet(out), ["sql_hash"], ["_m"], out="row_idx").drop("_m")
    n = results.groupBy("sql_hash").agg(F.count(F.lit(1)).alias("_n"))
    st = spark.read.parquet(st_path).join(n, "sql_hash", "left")
    st = st.select("sql_hash", "exec_ok", "error",
                   F.when(F.col("exec_ok"), F.coalesce("_n", F.lit(0))).alias("n_rows"))
    return st, results


def sql_hash(col) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.sha2(c, 256)


def execution_rows(queries: DataFrame, status: DataFrame, results: DataFrame, key="query_id", side="side",
                   sql="sql"):
    """Per (query, side): the executions table and the result rows expected by
    ``evaluation.compare_results`` / ``execution_details``."""
    q = queries.select(key, side, sql_hash(sql).alias("sql_hash"))
    ex = q.join(status, "sql_hash").select(key, side, "exec_ok", "error")
    rows = q.join(results, "sql_hash").select(key, side, "row_idx", "cells")
    return ex, rows
