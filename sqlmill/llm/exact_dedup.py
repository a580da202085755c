"""Exact dedup: group by a 128-bit content hash, keep one row per group, and
compare bytes inside the groups so that a hash collision never merges texts.

Texts are equal when they are identical after deleting every character of
``[\\x20\\x09-\\x0D]``.  Of equal texts the row with the most code points in the
original text stays, ties to the smallest id (a null id comes last).

Plan: one pass writes a narrow frame (id, hash, length, digest).  All grouping
runs on it, with map-side partial aggregates, so a group holding a third of
the rows sends one row per task.  Only texts of groups with two or more rows
are read again for the byte comparison, and they are pre-aggregated by
(hash, bytes) before the shuffle.

Edge cases: a null text counts as empty, empty texts form one group, rows that
repeat an id with the same text are copies of each other (all of them carry
``kept`` of that id; ``drop_copies`` leaves one), an empty table gives an empty result, further columns
are ignored here (``drop_copies`` returns them whatever their names); a very long text is one value of its row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_side, stored

SPACE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACE, "")


def md5_bytes(norm: Column) -> Column:
    return F.unhex(F.md5(norm))


def _best() -> Column:
    return F.min(F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("no_id"), F.col("id").alias("id")))


def dedup_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               content_hash: Callable[[Column], Column] = md5_bytes) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    texts = texts.select("id", F.length(F.coalesce("t", F.lit(""))).cast("long").alias("n"),
                         normalised(F.col("t")).alias("norm"))
    texts = texts.select("id", "n", "norm", content_hash(F.col("norm")).alias("h"))
    narrow = stored(texts.select("id", "n", "h", F.sha2("norm", 256).alias("sha")), "exact-narrow")
    groups = stored(narrow.groupBy("h").agg(F.count(F.lit(1)).alias("size"), _best().alias("best"))
                    .select("h", "size", F.col("best.id").alias("keep_id")), "exact-groups")

    repeated = groups.filter("size > 1").select("h")
    repeated = small_side(repeated, repeated.count(), 48)
    variants = texts.select("h", "norm").join(repeated, "h", "left_semi").groupBy("h", "norm").agg(F.lit(1).alias("one"))
    collided = stored(variants.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("h"),
                      "exact-collided")
    n_collided = collided.count()

    rows = narrow.join(groups, "h")
    if n_collided:
        # groups whose members differ in bytes are split by the bytes themselves
        side = small_side(collided, n_collided, 48)
        apart = texts.join(side, "h", "left_semi")
        by_text = apart.groupBy("h", "norm").agg(F.count(F.lit(1)).alias("size"), _best().alias("best"))
        split = (apart.join(by_text.select("h", "norm", "size", F.col("best.id").alias("keep_id")), ["h", "norm"])
                 .select("id", F.sha2("norm", 256).alias("sha"), "size", "keep_id"))
        rows = rows.join(side, "h", "left_anti").select("id", "sha", "size", "keep_id").unionByName(split)
    return rows.select(F.col("id").alias("doc_id"), "keep_id", F.col("size").alias("group_size"),
                       F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, one row per group of equal texts."""
    kept = dedup_rows(docs, id_col, text_col).filter("kept").select("doc_id", "text_sha256").distinct()
    # the row travels as one struct, so that no column of it can clash with a helper
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), F.sha2(normalised(F.col(text_col)), 256).alias("_key"))
    rows = rows.withColumn("_id", F.col("_row")[id_col])
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("text_sha256"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["_id", "_key"]).select("_row.*")
