"""Run logs, run status, batch throughput."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# fixed values: logging level name -> level shown to clients (default info)
LEVELS = {"debug": "debug", "info": "info", "warning": "warning", "error": "error", "critical": "error"}
TOTAL_STEPS = 6


def log_level(level_name) -> F.Column:
    """N17."""
    c = F.col(level_name) if isinstance(level_name, str) else level_name
    m = F.create_map(*[F.lit(x) for kv in LEVELS.items() for x in kv])
    return F.coalesce(F.try_element_at(m, F.lower(c)), F.lit("info"))


def latest_logs(logs: DataFrame, n: int = 100, run="run_id", order=("ts", "seq")) -> DataFrame:
    """The last ``n`` entries per run (newest first, rank 1 = newest).
    ``row_number() <= n`` with a literal ``n`` is planned with a per-task group
    limit before the shuffle, so a run with billions of lines ships ``n`` per task."""
    w = Window.partitionBy(run).orderBy(*[F.col(c).desc() for c in order])
    return logs.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= n)


def run_status(log: DataFrame, run="run_id", total_steps: int = TOTAL_STEPS) -> DataFrame:
    """Latest step and status per run, progress ``int(step / total * 100)``,
    start, end and duration in seconds.  All plain aggregates (max_by/min/max)."""
    latest = F.struct("ts", "seq")
    g = log.groupBy(run).agg(
        F.max_by("step", latest).alias("current_step"),
        F.max_by("event_type", latest).alias("_last_type"),
        F.min("ts").alias("start_time"), F.max("ts").alias("end_time"))
    status = (F.when(F.col("_last_type") == "error", F.lit("failed"))
              .when(F.col("current_step") >= total_steps, F.lit("completed")).otherwise(F.lit("running")))
    progress = (F.col("current_step") / total_steps * 100).cast("int")
    dur = F.timestamp_diff("MICROSECOND", F.col("start_time"), F.col("end_time")) / 1e6
    return g.select(run, "current_step", F.lit(total_steps).alias("total_steps"), progress.alias("progress"),
                    status.alias("status"), dur.alias("duration_sec"))


def batch_throughput(timings: DataFrame) -> DataFrame:
    """A8 per batch: samples per second."""
    return timings.withColumn("samples_per_sec", F.try_divide(F.col("n").cast("double"), F.col("seconds")))


def throughput_stats(timings: DataFrame, run="run_id", batch_size: int | None = None) -> DataFrame:
    """A8 per run: total samples, total time, seconds per sample, samples per second."""
    g = timings.groupBy(run).agg(F.sum("n").alias("total_samples"), F.sum("seconds").alias("total_time"),
                                 F.count(F.lit(1)).alias("n_batches"))
    out = g.select(run, "total_samples", "n_batches", "total_time",
                   F.try_divide(F.col("total_time"), F.col("total_samples").cast("double")).alias("avg_time_per_sample"),
                   F.try_divide(F.col("total_samples").cast("double"), F.col("total_time")).alias("throughput"))
    return out.withColumn("batch_size", F.lit(batch_size)) if batch_size else out
