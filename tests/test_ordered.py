"""Sources and sinks whose row order matters: many splits, torn elements, malformed files, failed jobs."""
import json
import os

import pytest
from pyspark.sql import functions as F

from sqlmill.sinks import writers as W
from sqlmill.sources import files as S
from sqlmill.sources import ordered as O

SCHEMA = "id int, text string, sub struct<a:int,l:array<string>>"


@pytest.fixture
def small_splits(spark):
    """Splits of 4 KB, so that files of some hundred KB have many."""
    keys = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "64"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def elements(n):
    odd = ['plain', 'a "quoted" } brace', '\\', 'ends with \\"', '{"x": [1, 2}', ']}[{,', 'é漢\n"', '', '\\\\"}']
    return [{"id": i, "text": odd[i % len(odd)] * (1 + i % 7) if i % 50 else odd[i % len(odd)] * 3000,
             "sub": {"a": i, "l": [odd[(i + 3) % len(odd)], "}"]} if i % 3 else None} for i in range(n)]


@pytest.mark.parametrize("indent", [None, 2])
def test_large_array_equals_the_whole_file_read(spark, tmp_path, small_splits, indent):
    rows = elements(600)
    (tmp_path / "big.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=indent is None))
    df = O.scan_large_json_array(spark, str(tmp_path), SCHEMA, ord_col="at")
    splits = spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions()
    assert splits > 20
    got = [json.loads(json.dumps(r.asDict(recursive=True))) for r in df.orderBy("at").drop("at").collect()]
    assert got == rows


def test_blocks_within_a_range(spark, tmp_path, monkeypatch):
    """One range, cut into blocks that its elements cross, of strings and brackets that blocks start in."""
    monkeypatch.setattr(O, "BLOCK_PIECES", 3)
    rows = elements(200)
    (tmp_path / "big.json").write_text(json.dumps(rows))
    (tmp_path / "small.json").write_text('[{"id": 900}]')
    df = O.scan_large_json_array(spark, str(tmp_path), SCHEMA, ord_col="at")
    got = [json.loads(json.dumps(r.asDict(recursive=True))) for r in df.orderBy("at").drop("at").collect()]
    assert got == rows + [{"id": 900, "text": None, "sub": None}]
    assert O._pieces(spark, str(tmp_path)).select("_f", "_b", "_k").distinct().count() > 50


def test_array_files_are_streamed(spark, tmp_path):
    df = spark.range(0, 25, 1, 1).select("id", F.concat(F.lit('"]\n,'), "id").alias("text"))
    for n, files in ((10, 3), (5, 5), (25, 1), (1 << 40, 1)):
        path = str(tmp_path / f"a{n}")
        S.write_json_arrays(df, path, n)
        found = sorted(f for f in os.listdir(path) if f.startswith("part-"))
        read = [json.load(open(os.path.join(path, f))) for f in found]
        assert len(read) == files and max(map(len, read)) <= n
        assert [tuple(r.values()) for a in read for r in a] == [tuple(r) for r in df.collect()]
    S.write_json_arrays(df.limit(0), str(tmp_path / "none"))
    assert S.scan_json_array(spark, str(tmp_path / "none"), "id long").count() == 0


def test_arrays_without_elements_and_several_files(spark, tmp_path):
    (tmp_path / "a.json").write_text("[]")
    (tmp_path / "b.json").write_text(' [ {"id": 1} ] ')
    (tmp_path / "c.json").write_text('[\n{"id": 2},\n{"id": 3}\n]\n')
    assert sorted(r["id"] for r in O.scan_large_json_array(spark, str(tmp_path), "id int").collect()) == [1, 2, 3]


@pytest.mark.parametrize("text", [' ', '[{"id": 1}', '[{"id": 1}, {"id": 2]', '[{"id": 1}] x', '[1, {"id": 1}]', '{"id": 1}', '[{"id": 1} {"id": 2}]',
                                  '[{"id": 1}][{"id": 2}]', '[{"id": "x}]', '[{"id": 1},, {"id": 2}]', '[{"id" 1}]', '[{"id": 1}, 2]'])
def test_malformed_arrays_raise(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception):
        O.scan_large_json_array(spark, str(tmp_path), "id int").collect()


def lines(path, name, start, n, blank=0):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for i in range(start, start + n):
            f.write(json.dumps({"id": i, "t": "x" * (i % 40)}) + "\n" + " \n" * blank)


def test_first_rows_open_a_prefix_of_the_files(spark, tmp_path, small_splits):
    path = str(tmp_path / "in")
    lines(path, "a.json", 0, 700, blank=1)
    lines(path, "b.json", 700, 50)
    lines(path, "c.json", 750, 900)
    with open(os.path.join(path, "z.json"), "w") as f:
        f.write("not json, never opened\n" * 10)
    for n in (1, 700, 705, 900):
        got = O.first_n_in_file_order(spark, path, "id int, t string", n).orderBy("ord").collect()
        assert [(r["ord"], r["id"]) for r in got] == [(i, i) for i in range(n)]
    with pytest.raises(Exception):
        O.first_n_in_file_order(spark, path, "id int, t string", 5000).collect()
    os.makedirs(tmp_path / "none")
    assert O.first_n_in_file_order(spark, str(tmp_path / "none"), "id int", 3).collect() == []
    lines(str(tmp_path / "few"), "a.json", 0, 3)
    assert O.first_n_in_file_order(spark, str(tmp_path / "few"), "id int, t string", 10).count() == 3


def test_zip_of_sources_split_differently(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(O, "RANGE_ROWS", 64)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    lines(a, "1.json", 0, 1000)
    for k, (start, n) in enumerate([(0, 10), (10, 600), (610, 390)]):
        lines(b, f"{k}.json", start, n)
    left = S.scan_jsonl(spark, a, "id int")
    right = S.scan_jsonl(spark, b, "id int, t string").withColumnRenamed("id", "other")
    got = O.zip_in_file_order(left, right).collect()
    assert sorted((r["ord"], r["id"], r["other"]) for r in got) == [(i, i, i) for i in range(1000)]
    plan = O.zip_in_file_order(left, right)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "rangepartitioning" not in plan
    lines(b, "9.json", 1000, 1)
    with pytest.raises(ValueError, match="differ in length"):
        O.zip_in_file_order(left, S.scan_jsonl(spark, b, "id int, t string").withColumnRenamed("id", "other"))


def test_export_keeps_the_order_and_is_whole(spark, tmp_path):
    rows = spark.range(5000).select(((F.col("id") * 37) % 5000).alias("o"), F.col("id").cast("string").alias("input"))
    path = str(tmp_path / "out")
    names = W.write_in_order(rows, path, "o", parts=7)
    want = [r["input"] for r in rows.orderBy("o").collect()]
    got = [json.loads(line)["input"] for n in names for line in open(os.path.join(path, n))]
    assert got == want and len(names) > 1
    listed = json.load(open(os.path.join(path, "_parts.json")))
    assert [p["name"] for p in listed] == names and sum(p["bytes"] for p in listed) == sum(os.path.getsize(os.path.join(path, n)) for n in names)
    back = S.with_file_order(S.scan_jsonl(spark, path, "input string")).orderBy("ord").collect()
    assert [r["input"] for r in back] == want
    with pytest.raises(FileExistsError):
        W.write_in_order(rows, path, "o")
    W.write_in_order(rows.limit(10), path, "o", overwrite=True)
    assert S.scan_jsonl(spark, path, "input string").count() == 10
    failing = rows.withColumn("input", F.when(F.col("o") == 4999, F.raise_error(F.lit("boom"))).otherwise(F.col("input")))
    gone = str(tmp_path / "failed")
    with pytest.raises(Exception):
        W.write_in_order(failing, gone, "o")
    assert sorted(os.listdir(tmp_path)) == ["out"]
