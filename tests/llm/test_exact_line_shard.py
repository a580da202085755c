import hashlib
from collections import Counter

from pyspark.sql import functions as F

from llm_helpers import by_id, make  # noqa: F401
from sqlmill.llm import exact_dedup, line_dedup, queries, sharding

ROWS = [(1, "a b"), (2, "ab"), (3, "a\tb "), (4, None), (5, ""), (6, " \n"), (7, "x" * 300_000), (8, "x" * 300_000), (9, "é é")]


def test_exact_groups_ties_nulls_and_long_texts(make):
    out = by_id(exact_dedup.dedup_rows(make(ROWS)), "keep_id", "group_size", "kept", "text_sha256")
    assert out[1][:3] == (3, 3, False) and out[3][:3] == (3, 3, True)
    assert out[4][:2] == (6, 3) and out[6][2]  # most code points of the original text
    assert out[7][:3] == (7, 2, True) and out[8][:3] == (7, 2, False)
    assert out[9] == (9, 1, True, hashlib.sha256("éé".encode()).hexdigest())


def test_exact_splits_groups_whose_hashes_collide(make):
    out = by_id(exact_dedup.dedup_rows(make(ROWS), content_hash=lambda norm: F.unhex(F.lit("00"))), "keep_id", "group_size")
    assert out == by_id(exact_dedup.dedup_rows(make(ROWS)), "keep_id", "group_size")


def test_exact_keeps_whole_rows(make, spark):
    docs = make([(1, "a"), (1, "a"), (2, "a "), (None, "n"), (None, "n"), (None, "m")]).withColumn("kept", F.lit("mine")).withColumn("id", F.lit(7))
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter([(2, "a "), (None, "n"), (None, "m")])
    assert exact_dedup.drop_copies(docs.limit(0)).count() == 0


def test_lines_remove_later_windows(make):
    text = "a\nb\nc\nd"
    docs = make([(1, text), (2, "z\na\nb\nc\ny"), (3, "b\nc\nd"), (4, None), (5, ""), (None, text), (6, "\n\n\n\n\n\n")])
    out = by_id(line_dedup.dedup_lines(docs.withColumn("lines", F.lit(1))), "text", "n_removed", "n_spans")
    assert out[1] == (text, 0, 0)
    assert out[2] == ("z\ny", 3, 1)
    assert out[3] == ("", 3, 1)
    assert out[4] == ("", 0, 0) and out[5] == ("", 0, 0)
    assert out[None] == (text, 0, 0)
    assert out[6] == ("", 6, 1)  # seven blank lines: four later windows cover all but the first line


def test_columns_that_clash_come_along(make):
    docs = make([(1, "a\nb\nc"), (2, "a\nb\nc\nd"), (3, None)])
    for name in ("_lines", "_cov", "_row", "key", "pos", "h1"):
        docs = docs.withColumn(name, F.lit(name))
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns + ["n_lines", "n_removed", "n_spans"]
    assert all(r[c] == c for r in out.collect() for c in docs.columns[5:])
    odd = docs
    for name in ("_p", "_n", "_k1", "_k2", "_cell", "_rn", "_offset", "shard"):
        odd = odd.withColumn(name, F.lit(name))
    shards = sharding.shuffle_to_shards(odd)
    assert shards.columns == [c for c in odd.columns if c != "shard"] + ["shard", "slot"]
    assert all(r["_p"] == "_p" and r["shard"] in range(16) for r in shards.collect())
    assert exact_dedup.drop_copies(make([(1, "a")]).withColumn("_sha", F.lit("mine"))).first()["_sha"] == "mine"


def test_shard_query_holds_its_contract(spark):
    import zlib
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = queries.op6_sharding(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        data = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))


def test_lines_merge_overlapping_windows_and_long_texts(make):
    lines = [f"line {i}" for i in range(20_000)]
    docs = make([(1, "\n".join(lines)), (2, "\n".join(["new"] + lines[5:9] + ["new"] + lines[100:19_000]))])
    out = by_id(line_dedup.dedup_lines(docs), "text", "n_removed", "n_spans")
    assert out[2] == ("new\nnew", 4 + 18_900, 2)
    assert line_dedup.dedup_lines(make([(1, "x")]).limit(0)).count() == 0


def test_lines_of_each_text_of_an_id_go_by_themselves(make):
    docs = make([(1, "a\nb\nc"), (2, "a\nb\nc\nd"), (2, "p\nq\nr\ns"), (2, "p\nq\nr\ns"), (2, "z\na\nb\nc")])
    out = line_dedup.dedup_lines(docs).collect()
    assert sorted((r["doc_id"], r["text"]) for r in out) == [(1, "a\nb\nc"), (2, "d"), (2, "p\nq\nr\ns"), (2, "p\nq\nr\ns"), (2, "z")]


def test_shards_have_exact_sizes_and_gapless_slots(make):
    docs = make([(i % 90, f"t{i % 7}") for i in range(1003)] + [(None, None)])
    rows = sharding.shuffle_to_shards(docs.repartition(5)).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == 1004 and max(sizes.values()) - min(sizes[s] for s in range(16)) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    few = sharding.shuffle_to_shards(make([(1, "a"), (2, "b")])).collect()
    assert len(few) == 2 and {r["slot"] for r in few} == {0}
    assert sharding.shuffle_to_shards(make([(1, "a")]).limit(0)).count() == 0


def test_communication_matrix_has_exact_sums_and_the_right_law():
    counts = [500, 0, 37, 1463]
    for seed in range(20):
        matrix = sharding.communication_matrix(counts, 16, seed)
        assert [sum(r) for r in matrix] == counts
        assert max(map(sum, zip(*matrix))) - min(map(sum, zip(*matrix))) <= 1
    import random
    rng = random.Random(3)
    drawn = Counter(sharding.hypergeometric(rng, 6, 4, 5) for _ in range(20_000))
    from math import comb
    for k in range(1, 6):
        assert abs(drawn[k] / 20_000 - comb(6, k) * comb(4, 5 - k) / comb(10, 5)) < 0.015


def test_shuffle_is_uniform_over_shards(make):
    rows = sharding.shuffle_to_shards(make([(i, "t") for i in range(4000)]).repartition(4), seed=5).collect()
    first_half = Counter(r["shard"] for r in rows if r["doc_id"] < 2000)
    assert all(90 <= first_half[s] <= 160 for s in range(16))
