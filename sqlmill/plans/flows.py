"""End-to-end flows composed from the operators.

Each flow is one driver function that builds DataFrames; Spark runs the work.
Model answers are written to the shared folder once (``persist_once``) before
they are used twice, because model calls are costly and not repeatable — a
recomputation after executor loss would otherwise ask the model again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sqltext import extract_sql
from ..operators import catalog as cat
from ..operators import evaluation as ev
from ..operators import generation as gen
from ..operators import planning as plan
from ..operators import prompts as pr
from ..operators import stats
from ..operators import validation as val
from ..session import persist_once
from ..sinks import writers
from ..sources.files import ensure_not_empty


@dataclass
class SynthesisConfig:
    total_samples: int = 50
    min_tables: int = 3
    max_tables: int = 8
    dialect: str = "mysql"
    blacklist: tuple = ()
    strict: bool = False
    export_format: str = "alpaca"
    validate: bool = True
    rules: tuple = ()


def synthesis(spark: SparkSession, columns: DataFrame, pk: DataFrame, fk: DataFrame, model, out_path: str,
              cfg: SynthesisConfig = SynthesisConfig(), totals: DataFrame | None = None,
              executed: DataFrame | None = None):
    """Catalog → cards → planning prompt → model → plan → allocation → DDL →
    generation prompt → model → samples (+ one top-up pass) → validation →
    export + statistics, for every database in ``columns`` at once.

    ``model(list[str]) -> list[str]``.  Returns a dict of DataFrames: plans,
    plan_errors, samples, verdicts, stats, and what went wrong on the way:
    rejected (answer lines that are no sample) and failed_topics (calls without
    an answer).  An empty catalog, plan, sample set or set of valid samples
    raises; ``cfg.validate = False`` skips validation.  ``executed`` = (sample_id,
    exec_ok, error) of probe runs joins the verdicts as their last stage."""
    # stage boundaries are written to the shared folder: this cuts lineage (a
    # lost executor recomputes from the last stage, not from the start) and
    # keeps each stage's plan small although its input feeds several branches
    catalog = persist_once(cat.assemble_catalog(columns, pk, fk, blacklist=cfg.blacklist), spark, "catalog")
    ensure_not_empty(catalog, "catalog")
    cards = cat.table_cards(catalog)
    text = cat.cards_text(cards)
    dbs = text.select("db_id")
    totals = totals if totals is not None else dbs.withColumn("total", F.lit(cfg.total_samples))
    prompts = text.join(totals, "db_id").select(
        F.col("db_id").alias("plan_id"), "db_id",
        pr.planning_prompt(F.col("cards_text"), F.col("total"), cfg.min_tables, cfg.max_tables,
                           cfg.dialect).alias("prompt"))
    answers = persist_once(gen.batch_inference(prompts, model, keys=("plan_id",), accept=gen.must_be_json), spark, "plan-answers")
    topics, perr = plan.parse_plans(answers.select("plan_id", F.coalesce("response", F.lit("")).alias("response")))
    topics = topics.join(prompts.select("plan_id", "db_id"), "plan_id")
    tables = catalog.select("db_id", "table_name")
    valid = plan.filter_topics(topics, tables, cfg.min_tables, cfg.max_tables)
    errors = plan.plan_errors(prompts, valid, perr)
    alloc = plan.allocate_samples(valid, totals.select(F.col("db_id").alias("plan_id"), "total"))
    targets = plan.topic_targets(alloc)
    chosen = valid.drop("count").join(targets, ["plan_id", "ord"])
    ddl = cat.topic_ddl(chosen, cat.table_ddl(catalog))
    tp = persist_once(chosen.join(ddl, ["plan_id", "ord"]).withColumn("topic_id", F.concat_ws(":", "plan_id", "ord")),
                      spark, "topics")
    ensure_not_empty(tp, "plan")

    def ask(df, count_col, name):
        p = df.select("topic_id", pr.generation_prompt(F.col("name"), F.col("ddl"), F.col(count_col),
                                                       cfg.dialect).alias("prompt"))
        a = persist_once(gen.batch_inference(p, model, keys=("topic_id",)), spark, name)
        s, lost = gen.parse_samples(a.where(F.col("error").isNull()), keys=("topic_id",))
        return s, lost, a.where(F.col("error").isNotNull()).select("topic_id", "error", "attempts")

    first, lost1, failed1 = ask(tp, "target", "gen-answers")
    short = gen.topic_shortfall(first, tp, keys=("topic_id",)).where("shortfall > 0")
    topup, lost2, failed2 = ask(tp.join(short.select("topic_id", "shortfall"), "topic_id"), "shortfall", "topup-answers")
    samples = gen.union_topics(first, topup, tp, keys=("topic_id",))
    samples = persist_once(samples.join(tp.select("topic_id", "db_id"), "topic_id").withColumn(
        "sample_id", F.xxhash64("topic_id", "pass", "line_no")), spark, "samples")
    ensure_not_empty(samples, "samples")
    if cfg.validate:
        # the catalog the model saw: tables on the blacklist are unknown here, too
        known = catalog.select("db_id", "table_name", F.explode("columns").alias("c")).select("db_id", "table_name", F.col("c.name").alias("column_name"))
        summary = persist_once(val.statement_summary(samples), spark, "statements")
        verdicts = persist_once(val.validate_samples(samples, known, strict=cfg.strict, summary=summary, executed=executed,
                                                     rules=cfg.rules), spark, "verdicts")
    else:
        verdicts = samples.withColumns({"valid": F.lit(True), "error_kind": F.lit(None).cast("string"), "error": F.lit(None).cast("string")})
    good = ensure_not_empty(val.valid_samples(verdicts), "set of valid samples")
    writers.export(good, out_path, cfg.export_format)
    return {"plans": alloc, "plan_errors": errors, "samples": samples, "verdicts": verdicts,
            "rejected": lost1.withColumn("pass", F.lit(1)).unionByName(lost2.withColumn("pass", F.lit(2))),
            "failed_topics": failed1.withColumn("pass", F.lit(1)).unionByName(failed2.withColumn("pass", F.lit(2))),
            "stats": stats.dataset_stats(good, group=("db_id",))}


def evaluation(spark: SparkSession, pairs: DataFrame, model, executed: tuple | None = None):
    """Pairs (run_id, ord, question, reference) → inference prompt → model →
    extracted SQL (written once) → text metrics and detail rows; optionally
    execution metrics when ``executed = (status, results)`` from X1 over the
    predictions and references is given.  Returns (metrics, details)."""
    prompts = pairs.select(F.concat_ws(":", "run_id", "ord").alias("id"), "run_id", "ord",
                           pr.build_prompt("question", training=False).alias("prompt"))
    answers = persist_once(gen.batch_inference(prompts, model, keys=("id", "run_id", "ord")), spark, "eval-answers")
    preds = answers.select("run_id", "ord", extract_sql(F.coalesce("response", F.lit(""))).alias("prediction"))
    refs = pairs.select("run_id", "ord", "question", "reference")
    ev.require_aligned(ev.alignment_report(preds, refs))
    ev.require_unique(refs)
    aligned = persist_once(ev.align_pairs(preds, refs), spark, "aligned")
    scored = persist_once(ev.scored_pairs(aligned), spark, "scored")
    # a failed call is scored as an empty prediction and counted beside the metrics
    failed = answers.groupBy("run_id").agg(F.count_if(F.col("error").isNotNull()).alias("n_failed_calls"))
    metrics = ev.metrics_from_scored(scored).join(failed, "run_id", "left")
    details = ev.details_from_scored(scored)
    if executed is not None:
        from ..operators.execution import execution_rows
        status, results = executed
        name = F.concat_ws(":", "run_id", "ord").alias("query_id")
        q = (aligned.select(name, F.lit("pred").alias("side"), F.col("prediction").alias("sql"))
             .unionByName(aligned.select(name, F.lit("ref").alias("side"), F.col("reference").alias("sql"))))
        ex, rows = execution_rows(q, status, results)
        det = ev.execution_details(ex, ev.compare_results(rows)).join(aligned.select(name, "run_id"), "query_id")
        metrics = metrics.join(ev.execution_rates(det), "run_id", "left")
    return metrics, details
