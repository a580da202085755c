"""File sources: JSON lines, JSON arrays, binary image files, upload manifests."""

from __future__ import annotations

import mimetypes
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import persist_once, ship_package

# fixed values: image types that Python's table may lack
MORE_IMAGE_TYPES = {".webp": "image/webp", ".avif": "image/avif", ".heic": "image/heic", ".heif": "image/heif",
                    ".svg": "image/svg+xml", ".jxl": "image/jxl"}


def image_types() -> dict[str, str]:
    """Lower-case extension -> MIME type of every known ``image/*`` type: Python's own table, its common
    non-standard types, the machine's ``mime.types`` files where there are any, and the additions."""
    table = mimetypes.MimeTypes(filter(os.path.isfile, mimetypes.knownfiles)).types_map
    known = {e.lower(): m for strict in (False, True) for e, m in table[strict].items() if m.startswith("image/")}
    return {**MORE_IMAGE_TYPES, **known}


def _any_case(extension: str) -> str:
    """A glob for an extension in any mix of cases; every character stands for itself."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else f"[{c}]" for c in extension)


def scan_jsonl(spark: SparkSession, path: str, schema) -> DataFrame:
    """One object per line; blank lines are skipped, a malformed line fails
    the job (FAILFAST).  An explicit schema avoids an inference pass."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def scan_json_array(spark: SparkSession, path: str, schema) -> DataFrame:
    """Every file holds one JSON array; files (in folders below, too) are read
    in parallel (a single file is not splittable)."""
    return (spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST")
            .option("recursiveFileLookup", "true").json(path))


def ensure_not_empty(df: DataFrame, what: str = "dataset") -> DataFrame:
    """S3: raise when there is no row (one cheap ``limit(1)`` job)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def with_file_order(df: DataFrame, ord_col: str = "ord") -> DataFrame:
    """Dense 0-based row positions in file order (path, split start, row), for
    sources whose order matters.

    The rows are stored once with their split and place in it, so both readers
    below see the same numbers.  Rows are numbered per split, the offsets of the
    splits are running sums over one row per split."""
    keyed = persist_once(df.withColumn("_f", F.col("_metadata.file_path")).withColumn("_b", F.col("_metadata.file_block_start"))
                         .withColumn("_m", F.monotonically_increasing_id()), df.sparkSession, "file-order")
    sizes = keyed.groupBy("_f", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_f", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = keyed.withColumn("_rn", F.row_number().over(Window.partitionBy("_f", "_b").orderBy("_m")))
    return (local.join(offsets, ["_f", "_b"]).withColumn(ord_col, (F.col("_off") + F.col("_rn") - 1).cast("bigint"))
            .drop("_f", "_b", "_m", "_rn", "_off"))


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Write files that hold one JSON array each (the shape S2 reads), of at most
    ``rows_per_file`` rows of one partition in its order.  A file's first line opens
    its array and its last one closes it, so rows stay rows of text: they stream
    into their files, and no task joins, sorts or holds them."""
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, held = 0, None  # what closes a row shows when the next one is there
        for batch in batches:
            out = []
            for row in batch.column(0).to_pylist():
                if held is not None:
                    out.append(held + ("]" if n % rows_per_file == 0 else ","))
                held = "[" + row if n % rows_per_file == 0 else row
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held + "]"], pa.string())], ["value"])
    ship_package(df.sparkSession)
    js = df.select(F.to_json(F.struct(*df.columns)).alias("j"))
    js.mapInArrow(lines, "value string").write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).text(path)


def b64(col) -> F.Column:
    """Unchunked base64 (as Python's b64encode); Spark may break lines every 76 chars."""
    c = F.col(col) if isinstance(col, str) else col
    return F.translate(F.base64(c), "\r\n", "")


def file_extension(name) -> F.Column:
    """Python ``os.path.splitext(name)[1]`` on a base name: from the last dot,
    leading dots not counted."""
    n = F.col(name) if isinstance(name, str) else name
    base = F.regexp_replace(n, r"^\.+", "")
    return F.when(base.contains("."), F.concat(F.lit("."), F.substring_index(base, ".", -1))).otherwise(F.lit(""))


def scan_images(spark: SparkSession, path: str) -> DataFrame:
    """S10 over a folder: files whose extension names an ``image/*`` type, content
    base64-encoded.  Names are listed first without reading content; of other
    files not a byte is read."""
    types = image_types()
    named = "*{" + ",".join(map(_any_case, sorted(types))) + "}"
    df = spark.read.format("binaryFile").option("pathGlobFilter", named).load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    ext = F.lower(file_extension(name))
    mime = F.try_element_at(F.create_map(*[F.lit(x) for kv in types.items() for x in kv]), ext)
    return (df.select(name.alias("name"), mime.alias("mime"), F.col("length").alias("size"), "content")
              .where(F.col("mime").isNotNull())
              .select("name", "mime", "size", b64("content").alias("payload")))


def image_payload(uploads: DataFrame) -> DataFrame:
    """S10 over uploaded rows (name, mime, content): keep ``image/*``, base64 the bytes."""
    return uploads.where(F.col("mime").startswith("image/")).select(
        "name", "mime", F.octet_length("content").cast("bigint").alias("size"), b64("content").alias("payload"))


def upload_manifest(uploads: DataFrame, id_col, keep=()) -> DataFrame:
    """Original name, stored name (unique id + original extension), size in bytes."""
    uid = F.col(id_col) if isinstance(id_col, str) else id_col
    return uploads.select(*keep, F.col("name").alias("original_name"),
                          F.concat(uid, file_extension("name")).alias("saved_name"),
                          F.octet_length("content").cast("bigint").alias("size"))
