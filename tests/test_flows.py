"""End-to-end flows with a deterministic stand-in model."""
import json
import re

from pyspark.sql import functions as F

from conftest import SF
from sqlmill.plans import flows
from sqlmill.session import scratch_path
from sqlmill.sources import fixtures


def model(prompts):
    out = []
    for p in prompts:
        tables = re.findall(r"### 表: (\w+)", p)
        if tables:  # planning prompt: topics of three consecutive tables, counts that do not sum up
            topics = [{"name": f"t{i}", "tables": tables[i:i + 3], "reason": "r", "count": 7, "dialect": "mysql"}
                      for i in range(0, len(tables) - 2, 2)]
            out.append("```json\n" + json.dumps({"topics": topics}, ensure_ascii=False) + "\n```")
            continue
        n = int(re.search(r"生成 (\d+) 条", p).group(1))
        t = re.findall(r"CREATE TABLE (\w+)", p)[0]
        lines = [json.dumps({"input": f"q{i}", "output": f"SELECT COUNT(*) FROM {t};"}) for i in range(max(n - 1, 0))]
        out.append("# samples\n" + "\n".join(lines))   # one short: forces a top-up pass
    return out


def test_synthesis_flow(spark):
    out = scratch_path(spark, "t-synth")
    cfg = flows.SynthesisConfig(total_samples=20, min_tables=2, max_tables=3)
    res = flows.synthesis(spark, fixtures.catalog_columns(spark, SF), fixtures.catalog_pk(spark, SF),
                          fixtures.catalog_fk(spark, SF), model, out, cfg)
    plans = res["plans"].groupBy("plan_id").agg(F.sum("count").alias("s")).collect()
    assert plans and all(r["s"] == 20 for r in plans)
    v = res["verdicts"]
    assert v.count() > 0 and v.where("not valid").count() == 0
    # every topic reached its target through the top-up pass
    per_topic = res["samples"].groupBy("topic_id").count()
    assert per_topic.where("count = 0").count() == 0
    assert spark.read.json(out).count() == v.count()
    st = res["stats"].collect()
    assert all(r["n_select"] == r["total_samples"] for r in st)


def test_evaluation_flow(spark):
    pairs = fixtures.prediction_pairs(spark, SF).where("run_id < 3")

    def echo(prompts):   # answers every question with a fenced constant
        return ["```sql\nSELECT COUNT(*) FROM orders;\n```" for _ in prompts]

    metrics, details = flows.evaluation(spark, pairs, echo)
    m = metrics.collect()
    assert len(m) == 3 and all(0.0 <= r["token_f1"] <= 1.0 for r in m)
    assert details.count() == pairs.count()


def test_blacklisted_tables_are_unknown_to_validation(spark):
    def forbidden(prompts):
        answers = model(prompts)
        return [a if "### " in p else a + '\n{"input":"q","output":"SELECT * FROM customer"}\nno sample' for p, a in zip(prompts, answers)]

    cfg = flows.SynthesisConfig(total_samples=6, min_tables=2, max_tables=3, blacklist=("customer",))
    two = fixtures.catalog_columns(spark, SF).where("db_id < 3")
    res = flows.synthesis(spark, two, fixtures.catalog_pk(spark, SF).where("db_id < 3"), fixtures.catalog_fk(spark, SF).where("db_id < 3"),
                          forbidden, scratch_path(spark, "t-black"), cfg)
    bad = res["verdicts"].where("output like '%customer%'")
    assert bad.count() > 0 and bad.where("valid").count() == 0
    assert res["rejected"].count() > 0 and res["failed_topics"].count() == 0


def test_flows_stop_on_nothing(spark):
    import pytest
    none = fixtures.catalog_columns(spark, SF).where("false")
    with pytest.raises(ValueError, match="catalog"):
        flows.synthesis(spark, none, fixtures.catalog_pk(spark, SF), fixtures.catalog_fk(spark, SF), model, scratch_path(spark, "t-none"))


def test_evaluation_counts_failed_calls_and_takes_string_runs(spark):
    import pytest
    pairs = spark.createDataFrame([("run:a", 1, "good", "SELECT 1"), ("run:a", 2, "bad", "SELECT 2")],
                                  "run_id string, ord long, question string, reference string")

    def half(prompts):
        if any("bad" in p for p in prompts):
            raise RuntimeError("no")
        return ["SELECT 1"] * len(prompts)
    import sqlmill.operators.generation as G
    wait, G.batch_inference.__defaults__ = G.batch_inference.__defaults__, tuple(
        0.0 if d == 1.0 and isinstance(d, float) else d for d in G.batch_inference.__defaults__)
    try:
        metrics, _ = flows.evaluation(spark, pairs, half)
        row = metrics.collect()[0]
        assert row["run_id"] == "run:a" and row["n_failed_calls"] == 1
        with pytest.raises(ValueError, match="share a key"):
            flows.evaluation(spark, pairs.unionByName(pairs), lambda p: ["SELECT 1"] * len(p))
    finally:
        G.batch_inference.__defaults__ = wait
