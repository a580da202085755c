"""File sources and sinks: round trips, JSON arrays, file order, cards JSON."""
import base64
import json

from pyspark.sql import functions as F

from sqlmill.operators import catalog as cat
from sqlmill.session import scratch_path
from sqlmill.sinks import writers as W
from sqlmill.sources import files as S
from sqlmill.sources import fixtures
from conftest import SF


def test_alpaca_round_trip_keeps_unicode(spark):
    df = spark.createDataFrame([("查询 ünï", "SELECT 1"), ("q", "")], "input string, output string")
    path = scratch_path(spark, "t-alpaca")
    W.export(df, path, "ALPACA", instruction="ins")
    raw = "".join(r[0] for r in spark.read.text(path).collect())
    assert "查询 ünï" in raw
    back = S.scan_jsonl(spark, path, W.alpaca_frame(df).schema)
    assert sorted(map(tuple, back.collect())) == sorted([("ins", "查询 ünï", "SELECT 1"), ("ins", "q", "")])


def test_unknown_export_format(spark):
    import pytest
    with pytest.raises(ValueError):
        W.export(spark.createDataFrame([("a", "b")], "input string, output string"), "/tmp/x", "csv")


def test_json_arrays_and_file_order(spark):
    df = spark.range(0, 50).select(F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id")).alias("v"))
    path = scratch_path(spark, "t-arrays")
    S.write_json_arrays(df.repartition(3), path)
    back = S.scan_json_array(spark, path, "k long, v string")
    assert sorted(r["k"] for r in back.collect()) == list(range(50))
    lines = scratch_path(spark, "t-lines")
    df.coalesce(1).write.json(lines)
    ordered = S.with_file_order(S.scan_jsonl(spark, lines, "k long, v string"))
    assert [(r["k"], r["ord"]) for r in ordered.orderBy("ord").collect()] == [(i, i) for i in range(50)]


def test_empty_guard(spark):
    import pytest
    with pytest.raises(ValueError):
        S.ensure_not_empty(spark.range(0))


def test_cards_json_document(spark):
    a = cat.assemble_catalog(fixtures.catalog_columns(spark, SF), fixtures.catalog_pk(spark, SF),
                             fixtures.catalog_fk(spark, SF))
    doc = cat.cards_json(cat.table_cards(a)).where("db_id = 1").collect()[0]["cards_json"]
    d = json.loads(doc)
    assert list(d) == sorted(d) and d["orders"]["foreign_keys"] == {"o_custkey": "customer.c_custkey"}
    assert d["orders"]["columns"][0] == {"name": "o_orderkey", "type": "BIGINT(20)", "desc": "主键"}


def test_scan_images_takes_every_case_and_type(spark, tmp_path):
    named = {"a.jpg": "image/jpeg", "photo.Jpg": "image/jpeg", "scan.Png": "image/png", "B.GIF": "image/gif", "c.weBP": "image/webp",
             "d.pict": "image/pict", "two.dots.tIf": "image/tiff"}
    for name in [*named, "note.txt", "png", "e.jpgx", "f.xjpg"]:
        (tmp_path / name).write_bytes(name.encode())
    got = {r["name"]: (r["mime"], r["size"], r["payload"]) for r in S.scan_images(spark, str(tmp_path)).collect()}
    assert got == {n: (m, len(n), base64.b64encode(n.encode()).decode()) for n, m in named.items()}
