"""Sinks: training files (Alpaca, ShareGPT, multimodal chat), sample files and
reports.  Every writer is a distributed ``DataFrameWriter`` call; nothing is
gathered on the driver.  Spark's JSON writer keeps non-ASCII text unescaped
(as ``ensure_ascii=False`` does)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------
DEFAULT_INSTRUCTION = "根据以下数据库表结构，将自然语言问题转换为SQL查询语句。"
IMAGE_QUESTION = "<image>请描述这张图片"
# --- end of fixed values ------------------------------------------------------


def _json(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    w = df.write.mode(mode).option("ignoreNullFields", "false").option("encoding", "UTF-8")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.json(path)


def alpaca_frame(samples: DataFrame, instruction: str | None = None) -> DataFrame:
    instr = DEFAULT_INSTRUCTION if instruction is None else instruction
    return samples.select(F.lit(instr).alias("instruction"), F.col("input"), F.col("output"))


def sharegpt_frame(samples: DataFrame) -> DataFrame:
    conv = F.array(F.struct(F.lit("user").alias("role"), F.col("input").alias("content")),
                   F.struct(F.lit("assistant").alias("role"), F.col("output").alias("content")))
    return samples.select(conv.alias("conversations"))


def export_alpaca(samples: DataFrame, path: str, instruction: str | None = None) -> None:
    """K1: {instruction, input, output} per line."""
    _json(alpaca_frame(samples, instruction), path)


def export_sharegpt(samples: DataFrame, path: str) -> None:
    """K2: {conversations: [user, assistant]} per line."""
    _json(sharegpt_frame(samples), path)


WRITERS = {"alpaca": export_alpaca, "sharegpt": export_sharegpt}


def export(samples: DataFrame, path: str, format_type: str = "alpaca", **kwargs) -> None:
    """K3: dispatch on the (case-insensitive) format name."""
    fn = WRITERS.get(format_type.lower())
    if fn is None:
        raise ValueError(f"unsupported export format: {format_type}")
    if fn is export_alpaca:
        fn(samples, path, kwargs.get("instruction"))
    else:
        fn(samples, path)


def write_samples(samples: DataFrame, path: str, partition_by="db_id") -> None:
    """K4: raw or validated {input, output} samples, one folder per database."""
    _json(samples.select(partition_by, "input", "output"), path, partition_by=partition_by)


def multimodal_frame(captions: DataFrame, name="original_name", text="description") -> DataFrame:
    msgs = F.array(F.struct(F.lit("user").alias("role"), F.lit(IMAGE_QUESTION).alias("content")),
                   F.struct(F.lit("assistant").alias("role"), F.col(text).alias("content")))
    return captions.select(msgs.alias("messages"), F.array(F.col(name)).alias("images"))


def export_multimodal(captions: DataFrame, folder: str, stamp: str | None = None) -> str:
    """K5: chat rows with the image's original name, under a timestamped name."""
    stamp = stamp or datetime.now().strftime("%Y%m%d_%H%M%S")
    path = f"{folder.rstrip('/')}/training_data_{stamp}.jsonl"
    _json(multimodal_frame(captions), path)
    return path


def write_report(metrics: DataFrame, details: DataFrame, folder: str) -> None:
    """K7/K8: metrics (one row per run) and detail rows as two outputs — never
    one document assembled on the driver."""
    _json(metrics, f"{folder.rstrip('/')}/metrics")
    _json(details, f"{folder.rstrip('/')}/details")


def write_in_order(rows: DataFrame, path: str, order, overwrite: bool = False, parts: int | None = None) -> list[str]:
    """K1, K2, K4 in sample order, whole or not at all: part files that, read one
    after the other, hold ``rows`` (JSON lines, without the order columns) in ``order``.

    Rows go through a range exchange and are written to a folder beside ``path``,
    which takes its name only when every part is there; a failed job leaves
    neither a part nor a folder.  ``_parts.json`` lists the part files in order
    with their bytes (file names alone sort wrongly beyond 100,000 parts); readers
    skip it.  Returns the part names."""
    import json
    import uuid
    spark = rows.sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(target) and not overwrite:
        raise FileExistsError(path)
    order = [order] if isinstance(order, str) else list(order)
    stage = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}._stage-{uuid.uuid4().hex}")
    try:
        keep = [c for c in rows.columns if c not in order]
        body = F.to_json(F.struct(*keep), {"ignoreNullFields": "false"}).alias("value")
        laid = rows.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order).select(body)
        laid.write.text(stage.toString())
        files = [(s.getPath().getName(), s.getLen()) for s in fs.listStatus(stage) if s.getPath().getName().startswith("part-")]
        files.sort(key=lambda f: int(f[0].split("-")[1]))
        out = fs.create(jvm.org.apache.hadoop.fs.Path(stage, "_parts.json"))
        out.write(bytearray(json.dumps([{"name": n, "bytes": b} for n, b in files]).encode()))
        out.close()
        if fs.exists(target):
            fs.delete(target, True)
        if not fs.rename(stage, target):
            raise OSError(f"cannot rename {stage.toString()} to {path}")
    except BaseException:
        fs.delete(stage, True)
        raise
    return [n for n, _ in files]
