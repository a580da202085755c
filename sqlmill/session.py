"""Spark session and shared-storage helpers.

On a cluster the session is created by the platform; the library only reads
settings from it.  ``get_spark`` is for local runs and tests.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "sqlmill") -> SparkSession:
    """Local session with the settings the library is tuned for.

    AQE is on so shuffle partitions coalesce at runtime and skewed join
    partitions split; ``shuffle_partitions`` is the upper bound AQE starts from.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus) * 2
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SQLMILL_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session (tests, one machine) without one gets a folder of its
    own, registered as its checkpoint folder; on a cluster executors would write
    to their own disks, so a missing setting is an error."""
    path = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    master = spark.sparkContext.master
    if not re.match(r"local(\[|$)", master):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share (master {master})")
    path = tempfile.mkdtemp(prefix="sqlmill-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


_SCRATCH: dict[str, list[str]] = {}


def drop_scratch(spark: SparkSession, keep: tuple = ()) -> None:
    """Deletes the stored intermediate tables of this application, but for the
    paths in ``keep``.  Call it when their readers are done."""
    left = []
    for path in _SCRATCH.get(spark.sparkContext.applicationId, []):
        if path in keep:
            left.append(path)
            continue
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    _SCRATCH[spark.sparkContext.applicationId] = left


def scratch_tables(spark: SparkSession) -> tuple:
    """The stored intermediate tables of this application that are still there."""
    return tuple(_SCRATCH.get(spark.sparkContext.applicationId, []))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder for one output."""
    base = shared_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def persist_once(df, spark: SparkSession, name: str):
    """Write ``df`` to parquet in the shared folder and read it back.

    Used where recomputation is not allowed (model calls are costly and not
    repeatable) and to cut lineage; survives executor loss, unlike caching.
    """
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``sqlmill`` importable on executors (once per application).

    Python functions that run in tasks (model stand-ins, tokenizers, writers)
    are pickled by reference to their module, so executors must be able to
    import the package.  It is zipped on the driver and distributed with
    ``addPyFile``."""
    import zipfile
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    zpath = os.path.join(tempfile.mkdtemp(prefix="sqlmill-pkg-"), "sqlmill.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)
