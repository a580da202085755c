"""Structured Streaming variants.

The reference's only stream is its progress/log push channel.  The stateless
text operators run unchanged on a streaming DataFrame; run status (T2) is a
streaming aggregation in update mode, keyed by run.  Checkpoints go to the
shared folder (``spark.checkpoint.dir``), so a restarted query resumes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sqltext import extract_sql, normalize_sql
from ..operators import runs as R
from ..session import scratch_path

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, max_files: int = 1) -> DataFrame:
    """Parquet files arriving in ``folder`` as a stream of run-log events."""
    ev = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(folder)
    return ev.select(F.col("user_id").alias("run_id"), "ts", F.col("event_id").alias("seq"), "event_type",
                     (F.col("event_id") % 6 + 1).alias("step"))


def stream_run_status(log: DataFrame, watermark: str | None = None) -> DataFrame:
    """T2 on a stream: one updated row per run per trigger.  With ``watermark``
    (e.g. '1 hour') state for runs idle longer than that can be dropped."""
    if watermark:
        log = log.withWatermark("ts", watermark)
    return R.run_status(log)


def stream_extract_sql(texts: DataFrame, text="model_text") -> DataFrame:
    """N8 + N9 on a stream of model outputs (stateless, append mode)."""
    return texts.withColumn("sql", extract_sql(text)).withColumn("normalized", normalize_sql("sql"))


def start(df: DataFrame, name: str, mode: str = "update", sink: str = "memory"):
    """Start a streaming query with its checkpoint in the shared folder."""
    spark = df.sparkSession
    return (df.writeStream.format(sink).queryName(name).outputMode(mode)
              .option("checkpointLocation", scratch_path(spark, f"stream-{name}")).start())
