"""Merkle manifest of a dataset: a hash per row, trees per group, one root, and a proof for every row.

Each row is a leaf: the hash of its columns, each written with its length.
Leaves of a group ascend by id; while several nodes are left, every ``ARITY``
consecutive ones become the hash of their hashes.  The groups' roots, in order,
give the dataset's root in the same way.  All hashes are lowercase hex SHA-256
of concatenated text.

Plan: leaves are computed in one scan and laid out by a range exchange on
(group, id, leaf), which splits a large group over many tasks; a leaf's rank is
its place in its task plus the counts of the group's earlier tasks.  A rank is
written as digits of base ``ARITY``.  Within a block of ``ARITY ** DEPTH``
leaves the digits are grouped away from the last to the first: each grouping
nests the child structs in their parent, all after one exchange on the block.
Block roots are leaves of the next, far smaller round.  Proofs need no joins:
a block's row is exploded digit by digit, and each step adds the siblings it
sees.  Only whole blocks (one row each) meet the path above them in a join.

Edge cases: null columns are hashed as ``-``, so a null differs from an empty
text; a null group is a group of its own, first; null ids come first in their
group; rows that repeat an id follow in order of their leaf hash, each is a
leaf with its own proof; a lone leaf is its group's root, a lone group's root
the dataset's; an empty table gives no rows; further columns are not read.  A
block's row holds at most ``ARITY ** DEPTH`` leaves of fixed size (plus what
``carry`` names), so long texts do not enter it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import stored

ARITY = 8
#: Levels of a block: blocks hold ARITY ** DEPTH leaves.
DEPTH = 4
_STEP = "struct<left:string,right:string>"


def leaf_hash(columns: list[Column]) -> Column:
    """Hash of the columns in order, each as ``bytes:value``, or ``-`` where null."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def proof_hash(proof: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def ranked(leaves: DataFrame, by: list[str], name: str) -> DataFrame:
    """``leaves`` with ``rank`` (from 0, in order of ``by``) in its ``group`` and the group's size ``n``."""
    # place = task * 2^33 + position in the task, whose rows are sorted
    laid = stored(leaves.repartitionByRange("group", *by).sortWithinPartitions("group", *by)
                  .withColumn("place", F.monotonically_increasing_id()), name)
    laid = laid.withColumn("task", F.expr("shiftright(place, 33)"))
    runs = laid.groupBy("group", "task").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    group = W.partitionBy("group")
    before = group.orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select(F.col("group").alias("g"), F.col("task").alias("k"), "first",
                       F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"), F.sum("size").over(group).alias("n"))
    same = F.col("group").eqNullSafe(F.col("g")) & (F.col("task") == F.col("k"))
    return laid.join(runs, same).withColumn("rank", F.expr("place - first + offset")).drop("g", "k", "place", "task", "first", "offset")


def _rolled(nodes: DataFrame) -> DataFrame:
    """Blocks of ``group, rank, n, node`` rows: ``group, block, n, h, node`` with nested children.

    A level exists while its group has several nodes there; below that a node is its only child."""
    size = ARITY ** DEPTH
    digits = [f"d{k}" for k in range(DEPTH)]
    level = nodes.select("group", "n", F.expr(f"rank div {size}").alias("block"),
                         *[F.expr(f"cast(rank div {ARITY ** k} % {ARITY} as int)").alias(d) for k, d in enumerate(digits)], "node")
    level = level.repartition("group", "block")
    for k, digit in enumerate(digits):
        above = digits[k + 1:]
        level = level.groupBy("group", "n", "block", *above).agg(F.sort_array(F.collect_list(F.struct(
            F.col(digit).alias("d"), F.col("node.h").alias("h"), F.col("node.kids").alias("kids")))).alias("kids"))
        joined = F.sha2(F.array_join(F.transform("kids", lambda x: x["h"]), ""), 256)
        hashed = F.when(F.col("n") > ARITY ** k, joined).otherwise(F.expr("kids[0].h"))
        level = level.select("group", "n", "block", *above, F.struct(hashed.alias("h"), "kids").alias("node"))
    return level.select("group", "n", "block", F.col("node.h").alias("h"), "node")


def _tree(nodes: DataFrame, name: str) -> DataFrame:
    """``group, block, n, node, root, path``: the blocks of the leaves, with the group's root and the path above the block."""
    size = ARITY ** DEPTH
    blocks = stored(_rolled(nodes), f"merkle-{name}")
    most = blocks.agg(F.max("n")).first()[0]
    if most is None or most <= size:
        return blocks.select("group", "block", "n", "node", F.col("h").alias("root"), F.expr(f"cast(array() as array<{_STEP}>)").alias("path"))
    tops = blocks.select("group", F.col("block").alias("rank"), F.expr(f"(n + {size - 1}) div {size}").alias("n"),
                         F.struct("h", F.col("block").alias("kids")).alias("node"))
    above = _proofs(_tree(tops, f"{name}-up")).select(F.col("group").alias("g"), F.col("leaf").alias("b"), "root", F.col("proof").alias("path"))
    same = F.col("group").eqNullSafe(F.col("g")) & (F.col("block") == F.col("b"))
    return blocks.drop("h").join(above, same).select("group", "block", "n", "node", "root", "path")


def _proofs(blocks: DataFrame) -> DataFrame:
    """Every leaf of the blocks: ``group, root, h, leaf`` (what the leaf carries) and ``proof``, its siblings from the leaf up."""
    keep = [c for c in blocks.columns if c not in ("block", "node", "path")]
    rows = blocks.select(*keep, F.col("path").alias("proof"), F.col("node.kids").alias("kids"))
    for k in reversed(range(DEPTH)):
        rows = rows.select(*keep, "proof", "kids", F.transform("kids", lambda x: x["h"]).alias("hs"))
        rows = rows.select(*keep, "proof", F.explode(F.expr(
            "transform(kids, (x, i) -> struct(x.h as h, x.kids as kids, array_join(slice(hs, 1, i), '') as left,"
            " array_join(slice(hs, i + 2, size(hs)), '') as right))")).alias("x"))
        step = F.when(F.col("n") > ARITY ** k, F.array(F.struct("x.left", "x.right"))).otherwise(F.expr(f"cast(array() as array<{_STEP}>)"))
        rows = rows.select(*keep, F.concat(step, "proof").alias("proof"), F.col("x.h").alias("h"), F.col("x.kids").alias("kids"))
    return rows.select(*[c for c in keep if c != "n"], "h", F.col("kids").alias("leaf"), "proof")


def manifest(docs: DataFrame, columns: list[str], group: str = "lang", id_col: str = "doc_id",
             carry: dict[str, Column] | None = None) -> DataFrame:
    """Per row of ``docs``: the id column, ``leaf, subroot, root, proof`` and the columns of ``carry``.

    ``proof`` lists the siblings left and right of the path, from the leaf's level to the root's."""
    carry = carry or {}
    leaves = docs.select(F.col(group).alias("group"), F.col(id_col).alias("id"), leaf_hash([F.col(c) for c in columns]).alias("h"),
                         F.struct(F.col(id_col).alias("id"), F.struct(F.lit(0).alias("_"), *[c.alias(n) for n, c in carry.items()]).alias("own")).alias("kids"))
    nodes = ranked(leaves, ["id", "h"], "merkle-leaves").select("group", "rank", "n", F.struct("h", "kids").alias("node"))
    blocks = _tree(nodes, "blocks").withColumnRenamed("root", "subroot")
    subroots = blocks.filter("block = 0").select(F.lit(0).alias("group"), F.col("group").alias("id"), "subroot")
    # the groups' roots are the leaves of one more tree, in the groups' order
    tops = ranked(subroots.select("group", "id", F.col("subroot").alias("h"), F.struct("id").alias("kids")), ["id"], "merkle-subroots")
    above = _proofs(_tree(tops.select("group", "rank", "n", F.struct("h", "kids").alias("node")), "groups"))
    above = above.select(F.col("leaf.id").alias("g"), "root", F.col("proof").alias("top"))
    blocks = blocks.join(above, F.col("group").eqNullSafe(F.col("g"))).select(
        "group", "block", "n", "node", "subroot", "root", F.concat("path", "top").alias("path"))
    return _proofs(blocks).select(F.col("leaf.id").alias(id_col), F.col("h").alias("leaf"), "subroot", "root", "proof",
                                  *[F.col("leaf.own")[n].alias(n) for n in carry])
