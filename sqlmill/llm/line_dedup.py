"""Line dedup with overlapping three-line windows.

Lines are the parts of a text between ``\\n``.  Every three consecutive lines,
blank ones included, form a window, identified by a 128-bit hash.  Of equal
windows in the whole corpus the first by (doc_id, position) stays; the lines
that later occurrences cover are removed, overlapping ones merged into spans.

Plan: windows are exploded once and written; the first occurrence per hash is
a partial aggregate, so a window in a third of all documents sends one row per
task; a shuffled join (split by AQE where skewed) marks later occurrences.

Edge cases: a null text counts as empty (one empty line, and ``''`` as text);
texts under three lines have no window; rows without an id stay whole and remove
nothing; rows that repeat an id count as one document, and each loses lines of
its own text only; an empty table gives no rows; further columns come along,
whatever their names.  A text's lines are an array of its row, so a very long
text is bounded by the row itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

_HASHED = """
transform(sequence(0, size(lines) - 3), i -> struct(
    i as pos,
    xxhash64(lines[i], lines[i + 1], lines[i + 2]) as h1,
    xxhash64('second', lines[i], lines[i + 1], lines[i + 2]) as h2))
"""
#: Lines before the first covered span, between spans, and after the last one.
_KEPT = """
flatten(transform(sequence(0, size(_first)), i ->
    slice(_lines,
          if(i = 0, 0, _last[i - 1] + 1) + 1,
          if(i = size(_first), size(_lines), _first[i]) - if(i = 0, 0, _last[i - 1] + 1))))
"""


def windows(docs: DataFrame) -> DataFrame:
    """``doc_id, key, pos, h1, h2`` of each window; ``key`` tells the texts of an id apart."""
    lines = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64("text").alias("key"), F.split("text", "\n").alias("lines"))
    lines = lines.filter(F.size("lines") >= 3)
    return lines.select("doc_id", "key", F.inline(F.expr(_HASHED)))


def covered_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, key, cov``: the sorted line numbers to remove from a text."""
    win = stored(windows(docs), "line-windows")
    firsts = (win.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "pos", "key")).alias("first"))
              .filter("n > 1").drop("n"))
    later = win.join(firsts, ["h1", "h2"]).filter("struct(doc_id, pos, key) != first")
    return (later.groupBy("doc_id", "key").agg(F.collect_set("pos").alias("pos"))
            .select("doc_id", "key", F.expr("array_sort(array_distinct(flatten(transform(pos, p -> array(p, p + 1, p + 2)))))").alias("cov")))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` reduced to the kept lines, plus ``n_lines,
    n_removed, n_spans`` (which replace columns of these names)."""
    cov = covered_lines(docs.select("doc_id", "text")).select(F.col("doc_id").alias("_cov_id"), F.col("key").alias("_cov_key"), F.col("cov").alias("_cov"))
    # the row travels as one struct, so that no column of it can clash with a helper
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"))
    text = F.coalesce("_row.text", F.lit(""))
    same = (F.col("_row.doc_id") == F.col("_cov_id")) & (F.xxhash64("_row.text") == F.col("_cov_key"))
    out = rows.join(cov, same, "left").select("_row", F.split(text, "\n").alias("_lines"), F.coalesce("_cov", F.array().cast("array<int>")).alias("_cov"))
    out = (out.withColumn("_first", F.expr("filter(_cov, (x, i) -> i = 0 or _cov[i - 1] < x - 1)"))
           .withColumn("_last", F.expr("filter(_cov, (x, i) -> i = size(_cov) - 1 or _cov[i + 1] > x + 1)")))
    made = {"n_lines": F.size("_lines").cast("long"), "n_removed": F.size("_cov").cast("long"), "n_spans": F.size("_first").cast("long"),
            "text": F.when(F.size("_cov") == 0, text).otherwise(F.array_join(F.expr(_KEPT), "\n"))}
    kept = [made[c].alias(c) if c in made else F.col("_row")[c].alias(c) for c in docs.columns]
    return out.select(*kept, *[v.alias(c) for c, v in made.items() if c not in docs.columns])
