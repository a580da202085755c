"""Sources whose row order matters, read without one task or one global sort:
first rows in file order (F1/S4), large JSON arrays by byte ranges (S2), and
two unkeyed sources put side by side (J1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordering import spread
from ..session import persist_once
from .files import scan_jsonl, with_file_order

#: Rows of one position range of ``zip_in_file_order``.
RANGE_ROWS = 1 << 16
#: Pieces of one block of a JSON array's byte range.
BLOCK_PIECES = 1 << 15
#: Bytes of JSON arrays that a task is meant to sort.
TASK_BYTES = 1 << 25


def _place(df: DataFrame) -> DataFrame:
    """Adds file, split start and order within the split (``_f``, ``_b``, ``_m``)."""
    return df.select(F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"),
                     F.monotonically_increasing_id().alias("_m"), *df.columns)


def first_n_in_file_order(spark: SparkSession, path: str, schema, n: int) -> DataFrame:
    """The first ``n`` objects of a folder of JSON lines, files in order of
    their paths, with ``ord`` (from 0).

    Only a growing prefix of the files is opened (1, then 2, 4, 8 … more) until it
    holds ``n`` lines that are not blank; counting reads no field.  Those files'
    rows then give their ``n`` least places (file, split, row), a top-k with a
    limit per task: no row outside the prefix is read or numbered."""
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
               .select("path"))
    taken: list[str] = []
    lines, step = 0, 1
    while lines < n:
        later = listing.where(F.col("path") > taken[-1]) if taken else listing
        more = [r["path"] for r in later.orderBy("path").limit(step).collect()]
        if not more:
            break
        lines += spark.read.text(more).where(F.trim("value", F.lit(" \t\r")) != "").count()
        taken += more
        step *= 2
    if not taken:
        return scan_jsonl(spark, path, schema).withColumn("ord", F.lit(0).cast("bigint")).limit(0)
    first = _place(scan_jsonl(spark, taken, schema)).orderBy("_f", "_b", "_m").limit(n)
    # at most n rows are left: numbering them needs no distribution
    place = F.row_number().over(Window.orderBy("_f", "_b", "_m"))
    return first.withColumn("ord", (place - 1).cast("bigint")).drop("_f", "_b", "_m")


def _outside(parts, parity: int):
    """The text outside string literals when the piece starts outside (0) or inside (1) of one."""
    return F.array_join(F.filter(parts, lambda x, i: i % 2 == parity), "")


def _opened(text):
    """Brackets opened less square brackets closed; curly ones close at the end of a piece."""
    return (F.length(text) - F.length(F.translate(text, "{[", ""))) - (F.length(text) - F.length(F.translate(text, "]", "")))


def _pieces(spark: SparkSession, path) -> DataFrame:
    """The text between closing braces, each piece with what it does to the bracket
    depth when it starts outside (``_d0``) and inside (``_d1``) of a string, and its quotes."""
    raw = spark.read.option("lineSep", "}").option("recursiveFileLookup", "true").text(path)
    p = _place(raw)
    p = p.withColumn("_parts", F.split(F.regexp_replace("value", r"\\[\s\S]", ""), '"', -1))  # escaped characters are no quotes
    # a split's rows are numbered in the low 33 bits
    block = F.floor(F.col("_m").bitwiseAND((1 << 33) - 1) / BLOCK_PIECES).alias("_k")
    p = p.select("_f", "_b", block, "_m", "value", (F.size("_parts") - 1).alias("_q"), _outside("_parts", 0).alias("_o0"), _outside("_parts", 1).alias("_o1"))
    # the brace that ends the piece counts where it stands outside of a string
    closes = lambda start: F.when((F.col("_q") + start) % 2 == 0, 1).otherwise(0)
    return p.select("_f", "_b", "_k", "_m", "value", "_q", (_opened(F.col("_o0")) - closes(0)).cast("bigint").alias("_d0"),
                    (_opened(F.col("_o1")) - closes(1)).cast("bigint").alias("_d1"))


def scan_large_json_array(spark: SparkSession, path, schema, ord_col: str | None = None) -> DataFrame:
    """S2 for large files: each file holds one JSON array of objects and is read by
    byte ranges on many tasks.

    A range is cut into blocks of at most ``BLOCK_PIECES`` pieces (texts up to a
    closing brace), so that a task's share is no whole range.  A block does not know
    whether it starts inside a string or how deep.  So each reports, for both start
    states, its quotes' parity and its change of depth; a prefix over one row per
    block fixes every block's state.  Blocks then cut their own elements where the
    depth returns to 1.  Only an element that crosses a border is put together from
    its fragments, and every element is parsed by itself (bounded by the element,
    not by the file).  Files of no bytes hold no rows (Spark skips them).  Text
    outside the elements that is not the array's own punctuation, an unclosed string or bracket, and
    elements that do not parse raise an error.

    ``ord_col`` adds sortable positions (file, range, element) as a struct."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    size = files.agg(F.sum("length")).first()[0] or 0  # of the listing: no content is read
    p = spread(_pieces(spark, path), ["_f", "_b", "_k"], -(-size // TASK_BYTES))
    within = Window.partitionBy("_f", "_b", "_k").orderBy("_m")
    before, upto = within.rowsBetween(Window.unboundedPreceding, -1), within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    p = p.withColumn("_par", F.coalesce(F.sum("_q").over(before), F.lit(0)) % 2)
    change = lambda s: F.when((F.col("_par") + s) % 2 == 0, F.col("_d0")).otherwise(F.col("_d1"))
    ranges = p.groupBy("_f", "_b", "_k").agg((F.sum("_q") % 2).alias("_q"), F.sum(change(0)).alias("_d0"), F.sum(change(1)).alias("_d1"))
    earlier = Window.partitionBy("_f").orderBy("_b", "_k").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_s", F.coalesce(F.sum("_q").over(earlier), F.lit(0)) % 2)
    ranges = ranges.withColumn("_d", F.when(F.col("_s") == 0, F.col("_d0")).otherwise(F.col("_d1")))
    ranges = persist_once(ranges.withColumn("_depth", F.coalesce(F.sum("_d").over(earlier), F.lit(0))), spark, "json-ranges")
    # a file's last piece is followed by no brace, so a whole array ends at depth -1
    ends = ranges.groupBy("_f").agg((F.sum("_q") % 2).alias("_q"), F.sum("_d").alias("_d"))
    if not ends.where((F.col("_q") != 0) | (F.col("_d") != -1)).isEmpty():
        bad = ends.where((F.col("_q") != 0) | (F.col("_d") != -1)).first()
        raise ValueError(f"not a JSON array: {bad['_f']}")

    states = ranges.select(F.col("_f").alias("_rf"), F.col("_b").alias("_rb"), F.col("_k").alias("_rk"), "_s", "_depth")
    t = p.join(states, (F.col("_f") == F.col("_rf")) & (F.col("_b") == F.col("_rb")) & (F.col("_k") == F.col("_rk")))
    t = t.withColumn("_q0", (F.col("_par") + F.col("_s")) % 2)
    t = t.withColumn("_after", F.col("_depth") + F.sum(F.when(F.col("_q0") == 0, F.col("_d0")).otherwise(F.col("_d1"))).over(upto))
    t = t.withColumn("_end", ((F.col("_after") == 1) & ((F.col("_q0") + F.col("_q")) % 2 == 0)).cast("int"))
    t = t.withColumn("_e", F.coalesce(F.sum("_end").over(before), F.lit(0)))
    joined = F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_m", "value"))), lambda x: x["value"]), "}"), F.lit("}"))
    groups = persist_once(t.groupBy("_f", "_b", "_k", "_e").agg(joined.alias("_t"), F.max("_end").alias("_done")), spark, "json-elements")
    torn = ((F.col("_e") == 0) & ((F.col("_b") > 0) | (F.col("_k") > 0))) | (F.col("_done") == 0)
    chain = Window.partitionBy("_f").orderBy("_b", "_k", "_e").rowsBetween(Window.unboundedPreceding, -1)
    torn_rows = groups.where(torn).withColumn("_chain", F.coalesce(F.sum("_done").over(chain), F.lit(0)))
    mended = torn_rows.groupBy("_f", "_chain").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_b", "_k", "_e", "_t"))), lambda x: x["_t"]), "").alias("_t"),
        F.min(F.struct("_b", "_k", "_e")).alias("_at"), F.max("_done").alias("_done"))
    whole = (groups.where(~torn).select("_f", "_b", "_k", "_e", "_t", F.lit(1).alias("_done"))
             .unionByName(mended.select("_f", "_at._b", "_at._k", "_at._e", "_t", "_done")))
    # what follows a file's last element is its closing bracket
    rest = r"^\s*\[?\s*\]\s*\}$"
    bad = lambda: F.raise_error(F.concat(F.lit("malformed JSON array: "), F.col("_f"))).cast("boolean")
    element = F.when(F.col("_done") == 1, F.when(F.col("_t").rlike(r"^\s*[\[,]\s*\{"), F.lit(True)).otherwise(bad()))
    whole = whole.where(element.otherwise(F.when(F.col("_t").rlike(rest), F.lit(False)).otherwise(bad())))
    parsed = F.from_json(F.expr("substring(_t, instr(_t, '{'))"), schema, {"mode": "FAILFAST"})
    element = F.col("_k") * (BLOCK_PIECES + 1) + F.col("_e")
    place = [F.struct(F.col("_f").alias("file"), F.col("_b").alias("range"), element.alias("element")).alias(ord_col)] if ord_col else []
    return whole.select(*place, parsed.alias("_v")).select(*([ord_col] if ord_col else []), "_v.*")


def zip_in_file_order(left: DataFrame, right: DataFrame, ord_col: str = "ord") -> DataFrame:
    """Row i of one file source beside row i of another (columns must differ), with ``ord`` from 0.

    Each source's rows get dense positions from the counts of its earlier splits, however it is
    split.  Ranges of positions are exchanged, so that equal ranges of both sources meet in one
    task; nothing is sorted globally.  Raises ValueError when the lengths differ."""
    sides = []
    for df in (left, right):
        placed = with_file_order(df, "_pos")
        sides.append(placed.withColumn("_range", F.floor(F.col("_pos") / RANGE_ROWS)))
    sizes = [s.agg(F.count(F.lit(1))).first()[0] for s in sides]
    if sizes[0] != sizes[1]:
        raise ValueError(f"sources differ in length: {sizes[0]} and {sizes[1]} rows")
    a, b = (s.repartition("_range") for s in sides)
    return a.join(b, ["_range", "_pos"]).withColumnRenamed("_pos", ord_col).drop("_range")
