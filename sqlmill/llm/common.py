"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import persist_once, ship_package

#: A side is broadcast only when its measured size stays under this many bytes.
BROADCAST_LIMIT = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage,
    survives lost executors, and gives every later reader the same rows."""
    return persist_once(df, df.sparkSession, f"llm-{name}")


def small_side(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint when ``rows * row_bytes`` proves it small."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_LIMIT else df


def tidy() -> None:
    """Hands memory that a task has freed back to the system: Python workers outlive their tasks and
    would hold the most that any of them needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # glibc only
        trim(0)


def python_ready(spark: SparkSession) -> None:
    """Executors can import this package."""
    ship_package(spark)
