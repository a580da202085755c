"""Image caption runs (F9, J5, A7, G2): requested files → captions → status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values
E_MISSING = "文件不存在"   # file does not exist


def resolve_requests(requested: DataFrame, files: DataFrame, mapping: DataFrame) -> DataFrame:
    """F9 + J5: every requested stored name, whether it exists, and its original
    name (the client's mapping, else the stored name itself).

    ``requested`` (file), ``files`` (saved_name, …), ``mapping`` (saved_name,
    original_name).  Both lookups are left joins; the mapping comes from one
    request, but no broadcast is forced: the planner sizes it."""
    f = files.select(F.col("saved_name").alias("file"), F.lit(True).alias("exists"))
    m = mapping.select(F.col("saved_name").alias("file"), F.col("original_name").alias("_orig"))
    j = requested.join(f, "file", "left").join(m, "file", "left")
    return j.select("file", F.coalesce("exists", F.lit(False)).alias("exists"),
                    F.coalesce("_orig", "file").alias("original_name"))


def caption_status(resolved: DataFrame, captions: DataFrame) -> DataFrame:
    """Per requested file: success with the description, or failed with the error
    (missing file, or the model call failed).  ``captions`` (file, description, error)."""
    j = resolved.join(captions, "file", "left")
    ok = F.col("exists") & F.col("error").isNull() & F.col("description").isNotNull()
    err = F.when(~F.col("exists"), F.lit(E_MISSING)).otherwise(F.col("error"))
    return j.select("file", "original_name", F.when(ok, "success").otherwise("failed").alias("status"),
                    F.when(ok, F.col("description")).alias("description"), F.when(~ok, err).alias("error"))


def caption_counts(status: DataFrame) -> DataFrame:
    """A7."""
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
