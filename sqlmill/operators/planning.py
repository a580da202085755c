"""Topic plans: parse model output, keep valid topics, allocate sample counts.

A plan is one model response (bounded: a handful of topics), so per-plan
arrays and the sequential allocation fold stay small no matter how many plans
there are; plans themselves are spread across tasks by ``plan_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsontext import with_extracted_json
from ..functions.text import py_strip

TOPIC = "struct<name:string,tables:array<string>,reason:string,count:double,dialect:string>"
# fixed values: error texts
E_FORMAT = "LLM返回的规划格式不正确"      # the plan returned by the model has the wrong format
E_NO_TOPIC = "没有有效的主题规划"          # no valid topic in the plan


def parse_plans(responses: DataFrame, key="plan_id", text="response"):
    """N10 + P1: (topics, errors).

    ``topics`` = (key, ord, name, tables, reason, count, dialect), ``ord`` the
    0-based position in the model's list; a bare JSON list is accepted as the
    topic list, otherwise the object must have ``topics``.  ``errors`` =
    (key, error) for responses without usable JSON or without topics."""
    ex = with_extracted_json(responses.select(key, text), text, "x")
    j = F.col("x.json")
    bare = py_strip(j).startswith("[")
    topics = F.when(bare, F.from_json(j, f"array<{TOPIC}>")).otherwise(
        F.from_json(j, f"struct<topics:array<{TOPIC}>>")["topics"])
    parsed = ex.select(key, F.col("x.error").alias("error"), topics.alias("topics"))
    # Split with generators, not filters: a filter on these derived columns
    # would be pushed below the projections and inline the whole extraction
    # expression into its condition.
    bad = F.col("error").isNotNull() | F.col("topics").isNull()
    errors = parsed.select(key, F.explode(F.when(bad, F.array(F.coalesce("error", F.lit(E_FORMAT))))).alias("error"))
    rows = parsed.select(key, F.posexplode(F.when(F.col("error").isNull(), F.col("topics"))).alias("ord", "t"))
    rows = rows.select(key, F.col("ord").cast("bigint").alias("ord"), "t.name", "t.tables", "t.reason", "t.count",
                       "t.dialect")
    return rows, errors


def filter_topics(topics: DataFrame, catalog_tables: DataFrame, min_tables: int, max_tables: int,
                  key="plan_id", db="db_id") -> DataFrame:
    """Required fields present; keep only tables the database has (order
    kept, exact names); drop topics with fewer than ``min_tables``; truncate to
    ``max_tables``.  ``topics`` must carry ``db``."""
    t = topics.where(F.col("name").isNotNull() & F.col("tables").isNotNull() & F.col("count").isNotNull())
    ex = t.select(key, "ord", db, F.posexplode("tables").alias("i", "table_name"))
    known = ex.join(catalog_tables.select(db, "table_name").distinct(), [db, "table_name"], "left_semi")
    kept = known.groupBy(key, "ord").agg(F.sort_array(F.collect_list(F.struct("i", "table_name"))).alias("k"))
    kept = kept.select(key, "ord", F.transform("k", lambda x: x["table_name"]).alias("valid_tables"))
    j = t.join(kept, [key, "ord"], "left").withColumn(
        "valid_tables", F.coalesce("valid_tables", F.array().cast("array<string>")))
    return (j.where(F.size("valid_tables") >= min_tables)
             .withColumn("tables", F.slice("valid_tables", 1, max_tables)).drop("valid_tables"))


def plan_errors(plan_keys: DataFrame, valid: DataFrame, parse_errors: DataFrame, key="plan_id") -> DataFrame:
    """Plans that failed to parse, or kept no valid topic."""
    empty = (plan_keys.select(key).distinct().join(parse_errors.select(key), key, "left_anti")
             .join(valid.select(key), key, "left_anti").select(key, F.lit(E_NO_TOPIC).alias("error")))
    return parse_errors.unionByName(empty)


def allocate_samples(valid: DataFrame, totals: DataFrame, key="plan_id") -> DataFrame:
    """Per plan, make the topic counts sum to the plan's ``total``.

    ``cur`` = sum of counts.  If ``cur == total`` nothing changes.  Otherwise
    keep the first ``max(1, total)`` topics; ``ratio = total / cur`` (1 when
    cur <= 0); walk the topics in order: each but the last gets
    ``min(max(1, round_half_even(count * ratio)), remaining - topics_after)``,
    the last gets ``max(1, remaining)``.  Output (key, ord, count)."""
    g = valid.groupBy(key).agg(F.sum("count").alias("cur"),
                               F.sort_array(F.collect_list(F.struct(F.col("ord").cast("bigint").alias("ord"),
                                                                    F.col("count").cast("double").alias("count"))))
                               .alias("t"))
    g = g.join(totals.select(key, F.col("total").cast("bigint").alias("total")), key)
    total, cur = F.col("total"), F.col("cur")
    capped = F.slice("t", 1, F.greatest(F.lit(1), total).cast("int"))
    n = F.size(capped)
    ratio = F.when(cur > 0, total / cur).otherwise(F.lit(1.0))
    indexed = F.transform(capped, lambda x, i: F.struct(i.alias("i"), x["ord"].alias("ord"), x["count"].alias("count")))
    init = F.struct(total.alias("rem"), F.array().cast("array<struct<ord:bigint,count:double>>").alias("out"))

    def step(acc, x):
        a = F.greatest(F.lit(1), F.bround(x["count"] * ratio, 0).cast("bigint"))
        c = F.when(x["i"] < n - 1, F.least(a, acc["rem"] - (n - x["i"] - 1))).otherwise(
            F.greatest(F.lit(1).cast("bigint"), acc["rem"]))
        return F.struct((acc["rem"] - c).alias("rem"),
                        F.concat(acc["out"], F.array(F.struct(x["ord"].alias("ord"),
                                                              c.cast("double").alias("count")))).alias("out"))
    folded = F.aggregate(indexed, init, step)["out"]
    result = F.when(cur == total, F.col("t")).otherwise(folded)
    return g.select(key, F.inline(result))


def topic_targets(allocated: DataFrame, key=("plan_id", "ord")) -> DataFrame:
    """F8: per topic the integer target ``round_half_even(count)``; zero targets are skipped."""
    tgt = F.bround("count", 0).cast("bigint")
    return allocated.select(*key, tgt.alias("target")).where(F.col("target") != 0)


def plan_json(valid: DataFrame, allocated: DataFrame, key="plan_id") -> DataFrame:
    """K6: per plan, the plan document {"topics": [{name, tables, reason, count, dialect}]} with the allocated
    counts (whole numbers, as the training targets are), topics in the plan's order."""
    counts = allocated.select(key, "ord", F.bround("count", 0).cast("bigint").alias("_count"))
    t = valid.join(counts, [key, "ord"])
    topic = F.struct("name", "tables", "reason", F.col("_count").alias("count"), "dialect")
    g = t.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("ord", topic.alias("topic")))).alias("_t"))
    return g.select(key, F.to_json(F.struct(F.transform("_t", lambda x: x["topic"]).alias("topics"))).alias("plan_json"))
