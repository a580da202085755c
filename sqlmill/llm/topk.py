"""Exact top-k by inner product over an M-tree of paged metric nodes.

Integer vectors get one more component, ``sqrt(M - |x|^2)`` with M the largest
squared norm, so that the Euclidean distance from a query (with 0 there) falls
as the inner product grows and the triangle inequality may prune.  The leaves
are pages of vectors around a pivot, with covering radius and every vector's
distance to its pivot; inner nodes (subtrees) hold pivots around a routing
vector in the same way.  A query visits nodes best first by the least distance
they allow, skips nodes and vectors by stored distances alone where the
triangle inequality permits, and scores the rest exactly in integers.

Plan: equal vectors are collapsed first (only the k + 1 smallest ids of each
can appear in a result), so a vector that a third of all rows share is one
entry.  Pivots are a bounded sample; pages over ``PAGE_ROWS`` split, subtrees
hold at most about ``SUBTREE_ROWS``.  Queries meet their nearest subtree first
and then, with the bound found there, only subtrees that can still matter.
Queries go in blocks of ``QUERY_BLOCK``.  The driver holds pivots and node
headers only (at most ``PIVOTS`` and their splits).

Edge cases: rows without an id, with a null vector, or with null or non-finite
components take no part; rows equal in id and vector count once; shorter
vectors count as filled up with zeros; ties go to the smaller id; an empty
table or query set gives no rows; further columns are left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import python_ready, stored

#: Most pivots: bounds what the driver and a broadcast hold.
PIVOTS = 4096
PAGE_ROWS = 256
SUBTREE_ROWS = 8192
QUERY_BLOCK = 4096
#: Distances are rounded numbers; a bound must miss by more than this share.
SLACK = 1e-9


def quantised(embeddings: DataFrame, scale: float = 256.0) -> DataFrame:
    """``vec_id, v`` with ``floor(scale * x)`` of each component as long."""
    fine = embeddings.filter("vec_id is not null and embedding is not null and not exists(embedding, "
                             "x -> x is null or isnan(x) or abs(cast(x as double)) = double('infinity'))")
    return fine.select("vec_id", F.expr(f"transform(embedding, x -> cast(floor({scale}D * cast(x as double)) as bigint))").alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows of one matrix, filled up with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(lists.value_lengths())
    flat = np.asarray(lists.flatten(), np.float64)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def lifted(x: np.ndarray, most: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(most - (x * x).sum(1), 0))[:, None]])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0))


def _nearest(pivots: np.ndarray, width: int, most: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = lifted(matrix(batch.column(batch.schema.get_field_index("v")), width), most)
                near = np.concatenate([distances(x[k:k + 1024], pivots).argmin(1) for k in range(0, len(x), 1024)])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int32())], [*batch.schema.names, "pivot"])
    return run


def _page(pivots: np.ndarray, width: int, most: float):
    """One row per page: its vectors and ids, their distances to the pivot, the covering radius."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        x = matrix(pa.array(rows["v"]), width)
        pivot = int(rows["pivot"].iloc[0])
        far = distances(lifted(x, most), pivots[pivot:pivot + 1])[:, 0]
        ids = [list(i) for i in rows["ids"]]
        return pd.DataFrame({"subtree": [int(rows["subtree"].iloc[0])], "pivot": [pivot], "radius": [float(far.max())],
                             "n": [len(x)], "vectors": [x.tobytes()], "dists": [far.tobytes()], "ids": [ids]})
    return run


def grown(pivots: np.ndarray, counts: dict[int, int]) -> tuple[dict[int, int], list[tuple[int, int, int]], np.ndarray, list[int]]:
    """Splits of each pivot, ``(pivot, split, subtree)``, routing vectors, and the route of each subtree.

    Routing vectors are pivots far from each other; pivots go to the nearest, and
    subtrees fill up with pages in order of distance."""
    total = sum(counts.values())
    routes = [0]
    gap = distances(pivots, pivots[:1])[:, 0]
    while len(routes) < min(len(pivots), -(-total // SUBTREE_ROWS)):
        routes.append(int(gap.argmax()))
        gap = np.minimum(gap, distances(pivots, pivots[routes[-1:]])[:, 0])
    far = distances(pivots, pivots[routes])
    splits, where, route_of = {}, [], []
    for r in range(len(routes)):
        room = 0
        for p in sorted(np.flatnonzero(far.argmin(1) == r), key=lambda p: far[p, r]):
            n = counts.get(int(p), 0)
            if not n:
                continue
            splits[int(p)] = -(-n // (4 * PAGE_ROWS))
            for s in range(splits[int(p)]):
                if room <= 0:
                    route_of.append(r)
                    room = SUBTREE_ROWS
                where.append((int(p), s, len(route_of) - 1))
                room -= n // splits[int(p)]
    return splits, where, pivots[routes], route_of


def search(q: np.ndarray, pages: list[dict], pivots: np.ndarray, route: np.ndarray, most: float, k: int,
           floor: float) -> list[tuple[int, int]]:
    """Best ``k`` (score, id) for one query in one subtree, of at least the score ``floor``.

    ``pages``: pivot, radius, n, vectors, dists, ids, and ``up``: the pivot's distance to the route."""
    norm = float(q @ q)
    lift = np.append(q, 0.0)

    def reach(score: float) -> float:
        return np.sqrt(max(norm + most - 2 * score, 0.0)) * (1 + SLACK) + 1e-6 if score > -np.inf else np.inf

    best: list[tuple[int, int]] = []  # smallest (score, -id) first
    limit = reach(floor)
    to_route = float(np.linalg.norm(lift - route))
    queue = [(max(abs(to_route - p["up"]) - p["radius"], 0.0), False, i, 0.0) for i, p in enumerate(pages)]
    heapq.heapify(queue)
    while queue:
        least, opened, i, d = heapq.heappop(queue)
        if least > limit:
            break
        page = pages[i]
        if not opened:  # the bound came from stored distances; now the pivot's own
            d = float(np.linalg.norm(lift - pivots[page["pivot"]]))
            heapq.heappush(queue, (max(least, d - page["radius"]), True, i, d))
            continue
        near = np.flatnonzero(np.abs(page["dists"] - d) <= limit)
        if not len(near):
            continue
        scores = page["vectors"][near] @ q
        bar = best[0][0] if len(best) == k else floor
        for j in np.flatnonzero(scores >= bar):
            score = int(scores[j])
            for vec_id in page["ids"][near[j]]:
                if len(best) < k:
                    heapq.heappush(best, (score, -int(vec_id)))
                elif (score, -int(vec_id)) > best[0]:
                    heapq.heapreplace(best, (score, -int(vec_id)))
        if len(best) == k:
            limit = min(limit, reach(max(best[0][0], floor)))
    return [(s, -i) for s, i in best]


def _searched(pivots: np.ndarray, routes: np.ndarray, route_of: list[int], width: int, most: float, k: int):
    def run(key, queries: pd.DataFrame, pages: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"qid": [], "vec_id": [], "score": []}
        if len(queries) and len(pages):
            route = routes[route_of[int(key[0])]]
            own = [{"pivot": int(p.pivot), "radius": p.radius, "up": float(np.linalg.norm(pivots[int(p.pivot)] - route)),
                    "vectors": np.frombuffer(p.vectors).reshape(int(p.n), width), "dists": np.frombuffer(p.dists), "ids": p.ids}
                   for p in pages.itertuples()]
            x = matrix(pa.array(queries["v"]), width)
            for qid, q, floor in zip(queries["qid"], x, queries["floor"]):
                for score, vec_id in search(q, own, pivots, route, most, k, floor):
                    for c, value in zip(out, (qid, vec_id, score)):
                        out[c].append(value)
        return pd.DataFrame(out).astype("int64")
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` for each row of ``vectors`` (``vec_id, v``) where ``is_query`` holds."""
    spark = vectors.sparkSession
    python_ready(spark)
    rows = stored(vectors.dropDuplicates(["vec_id", "v"]), "topk-vectors")
    by_vector = W.partitionBy("v").orderBy("vec_id")
    entries = stored(rows.withColumn("k", F.row_number().over(by_vector)).filter(F.col("k") <= k + 1)
                     .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "topk-entries")
    square = F.expr("aggregate(v, 0D, (a, x) -> a + cast(x as double) * x)")
    shape = entries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"), F.max(square).alias("most")).first()
    n, width, most = shape["n"], shape["width"] or 0, shape["most"] or 0.0
    asked = rows.filter(is_query)
    questions = stored(asked.groupBy("v").agg(F.min("vec_id").alias("qid")), "topk-questions")
    blocks = -(-questions.count() // QUERY_BLOCK)
    schema = "query_id long, rank int, vec_id long, score long"
    if not n or not blocks:
        return spark.createDataFrame([], schema)

    sample = entries.orderBy(F.xxhash64("v"), "v").limit(max(1, min(PIVOTS, n // PAGE_ROWS))).select("v").toArrow()
    pivots = lifted(matrix(sample.column("v"), width), most)
    near = stored(entries.mapInArrow(_nearest(pivots, width, most), "v array<long>, ids array<long>, pivot int"), "topk-near")
    counts = {r["pivot"]: r["n"] for r in near.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).collect()}
    splits, where, routes, route_of = grown(pivots, counts)
    parts = spark.createDataFrame(list(splits.items()), "pivot int, splits int")
    subtrees = spark.createDataFrame(where, "pivot int, split int, subtree int")
    split = F.expr("cast(pmod(xxhash64(v), splits) as int)")
    placed = near.join(F.broadcast(parts), "pivot").withColumn("split", split).join(F.broadcast(subtrees), ["pivot", "split"])
    pages = stored(placed.groupBy("pivot", "split").applyInPandas(
        _page(pivots, width, most), "subtree int, pivot int, radius double, n int, vectors binary, dists binary, "
        "ids array<array<long>>"), "topk-pages")
    heads = pages.select("subtree", "pivot", "radius").collect()
    reach = np.zeros(len(route_of))  # covering radius of each subtree around its routing vector
    for r in heads:
        up = float(np.linalg.norm(pivots[r["pivot"]] - routes[route_of[r["subtree"]]]))
        reach[r["subtree"]] = max(reach[r["subtree"]], up + r["radius"])
    centres = routes[route_of]
    block = F.expr(f"cast(pmod(xxhash64(v), {blocks}) as int)")
    questions = questions.withColumn("block", block)
    in_blocks = pages.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def routed(first: bool):
        """Gives each question the subtree that may be nearest, or all others that can still hold a better row."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = matrix(batch.column(0), width)
                far = distances(np.hstack([x, np.zeros((len(x), 1))]), centres)
                home = np.maximum(far - reach, 0).argmin(1) if len(centres) > 1 else np.zeros(len(x), int)
                if first:
                    at, to = np.arange(len(x)), home
                else:
                    floor = np.asarray(batch.column(3), np.float64)
                    limit = np.sqrt(np.maximum((x * x).sum(1) + most - 2 * floor, 0)) * (1 + SLACK) + 1e-6
                    open_ = far - reach <= limit[:, None]
                    open_[np.arange(len(x)), home] = False
                    at, to = np.nonzero(open_)
                columns = [c.take(pa.array(at)) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(to, pa.int32())], [*batch.schema.names, "subtree"])
        return run

    found = _searched(pivots, routes, route_of, width, most, k + 1)
    answer = "qid long, vec_id long, score long"

    def visit(asked: DataFrame, first: bool) -> DataFrame:
        sent = asked.mapInArrow(routed(first), "v array<long>, qid long, block int, floor double, subtree int")
        return (sent.groupBy("subtree", "block").cogroup(in_blocks.groupBy("subtree", "block")).applyInPandas(found, answer))

    home = stored(visit(questions.withColumn("floor", F.lit(float("-inf"))).select("v", "qid", "block", "floor"), True), "topk-home")
    bound = home.groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"))
    bound = bound.select("qid", F.when(F.col("n") > k, F.col("low").cast("double")).otherwise(F.lit(float("-inf"))).alias("floor"))
    again = questions.join(bound, "qid", "left").select(
        "v", "qid", "block", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    both = home.unionByName(visit(again, False))
    order = W.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    best = both.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)
    # every row that asks with this vector, without its own id
    who = asked.select(F.col("vec_id").alias("query_id"), "v").join(questions.select("v", "qid"), "v").select("query_id", "qid")
    answers = who.join(best, "qid").filter("vec_id != query_id")
    ranked = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (answers.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
