"""Scoring predictions against references: text metrics, result comparison,
execution rates and reports.

Alignment is by key, never by position: every input carries ``(run_id, ord)``
(text pairs) or ``query_id`` (execution results).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sqltext import normalize_sql
from ..functions.text import token_set

NAN_MARK = "\u0000NaN"   # canonical NaN cell: never equal to anything
NULL_MARK = "\u0000NULL"  # canonical NULL cell: equal to NULL


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ------------------------------------------------------------------ alignment

def align_pairs(preds: DataFrame, refs: DataFrame, keys=("run_id", "ord")) -> DataFrame:
    """Positional zip as an inner equi-join on the alignment keys."""
    return preds.join(refs, list(keys), "inner")


def alignment_report(preds: DataFrame, refs: DataFrame, keys=("run_id", "ord"),
                     run="run_id") -> DataFrame:
    """Per run: matched pairs and keys present on one side only (the reference
    raises on a length mismatch; ``require_aligned`` does that)."""
    p = preds.select(*keys).withColumn("_p", F.lit(True))
    r = refs.select(*keys).withColumn("_r", F.lit(True))
    j = p.join(r, list(keys), "full")
    return j.groupBy(run).agg(
        F.count_if(F.col("_p") & F.col("_r")).alias("n_pairs"),
        F.count_if(F.col("_r").isNull()).alias("n_pred_only"),
        F.count_if(F.col("_p").isNull()).alias("n_ref_only"))


def require_aligned(report: DataFrame) -> None:
    """Action: raise if any run has unmatched keys."""
    bad = report.where((F.col("n_pred_only") > 0) | (F.col("n_ref_only") > 0)).limit(1).collect()
    if bad:
        raise ValueError(f"predictions and references do not align: {bad[0].asDict()}")


def require_unique(refs: DataFrame, keys=("run_id", "ord")) -> None:
    """Action: raise if a key occurs twice, as the pairs would multiply."""
    twice = refs.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"rows share a key: {twice[0].asDict()}")


def first_n(df: DataFrame, n: int, order="ord") -> DataFrame:
    """the first ``n`` rows in key order (distributed top-k, not a sort)."""
    return df.orderBy(order).limit(n)


# ------------------------------------------------------------------ text metrics

def exact_match_col(pred="prediction", ref="reference") -> Column:
    """Equal after normalisation; texts that are equal as they are need no lexing."""
    return F.when(_c(pred) == _c(ref), F.lit(True)).otherwise(normalize_sql(_c(pred)) == normalize_sql(_c(ref)))


def token_f1_col(pred="prediction", ref="reference") -> Column:
    """F1 of the distinct lower-cased word-token sets; 0 if either is empty
    or they share nothing.  Arithmetic in the reference's order."""
    p, r = token_set(_c(pred)), token_set(_c(ref))
    common = F.size(F.array_intersect(p, r)).cast("double")
    np_, nr = F.size(p).cast("double"), F.size(r).cast("double")
    prec, rec = F.try_divide(common, np_), F.try_divide(common, nr)
    f1 = F.lit(2.0) * prec * rec / (prec + rec)
    return F.when((np_ == 0) | (nr == 0) | (common == 0), F.lit(0.0)).otherwise(f1)


def text_match_details(pairs: DataFrame, keys=("run_id", "ord")) -> DataFrame:
    """Per-row detail (question, reference, prediction stripped; exact_match flag)."""
    from ..functions.text import py_strip
    return pairs.select(*keys, py_strip("question").alias("question"),
                        py_strip("reference").alias("reference"),
                        py_strip("prediction").alias("prediction"),
                        exact_match_col().alias("exact_match"))


def with_token_f1(pairs: DataFrame, pred="prediction", ref="reference", out="f1") -> DataFrame:
    """Token F1 as a column, with each side's token set computed once in its own
    projection (the F1 formula uses every set several times; the optimizer keeps
    non-cheap expressions from being inlined into all of those uses)."""
    d = pairs.withColumns({"_pt": token_set(_c(pred)), "_rt": token_set(_c(ref))})
    return _f1_of_sets(d, out)


def _f1_of_sets(d: DataFrame, out: str) -> DataFrame:
    """Token F1 of the token sets ``_pt`` and ``_rt``, which are dropped."""
    d = d.withColumns({"_np": F.size("_pt").cast("double"), "_nr": F.size("_rt").cast("double"),
                       "_cm": F.size(F.array_intersect("_pt", "_rt")).cast("double")})
    prec, rec = F.try_divide(F.col("_cm"), F.col("_np")), F.try_divide(F.col("_cm"), F.col("_nr"))
    f1 = F.when((F.col("_np") == 0) | (F.col("_nr") == 0) | (F.col("_cm") == 0), F.lit(0.0)).otherwise(
        F.lit(2.0) * prec * rec / (prec + rec))
    return d.withColumn(out, f1).drop("_pt", "_rt", "_np", "_nr", "_cm")


def with_exact_match(pairs: DataFrame, pred="prediction", ref="reference", out="exact_match") -> DataFrame:
    return pairs.withColumn(out, exact_match_col(pred, ref))


def text_metrics(pairs: DataFrame, group=("run_id",)) -> DataFrame:
    """E1 + E3 in one pass: exact-match rate, mean token F1, sample count (0 on empty)."""
    d = with_token_f1(with_exact_match(pairs, out="_em"), out="_f1")
    return d.groupBy(*group).agg(
        F.coalesce(F.avg(F.col("_em").cast("double")), F.lit(0.0)).alias("exact_match"),
        F.coalesce(F.avg("_f1"), F.lit(0.0)).alias("token_f1"),
        F.count(F.lit(1)).alias("total_samples"))


def scored_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs with both per-row scores (``exact_match`` flag, token ``f1``), so a
    report can write details and metrics from one scoring pass."""
    return with_token_f1(with_exact_match(pairs))


def metrics_from_scored(scored: DataFrame, group=("run_id",)) -> DataFrame:
    """E1 + E3 over already scored pairs."""
    return scored.groupBy(*group).agg(
        F.coalesce(F.avg(F.col("exact_match").cast("double")), F.lit(0.0)).alias("exact_match"),
        F.coalesce(F.avg("f1"), F.lit(0.0)).alias("token_f1"),
        F.count(F.lit(1)).alias("total_samples"))


def details_from_scored(scored: DataFrame, keys=("run_id", "ord")) -> DataFrame:
    from ..functions.text import py_strip
    return scored.select(*keys, py_strip("question").alias("question"), py_strip("reference").alias("reference"),
                         py_strip("prediction").alias("prediction"), "exact_match")


def exact_match(pairs: DataFrame, group=("run_id",)) -> DataFrame:
    """E1."""
    return pairs.groupBy(*group).agg(
        F.coalesce(F.avg(exact_match_col().cast("double")), F.lit(0.0)).alias("exact_match"),
        F.count(F.lit(1)).alias("total_samples"))


def avg_token_f1(pairs: DataFrame, group=("run_id",)) -> DataFrame:
    """E3."""
    return with_token_f1(pairs, out="_f1").groupBy(*group).agg(
        F.coalesce(F.avg("_f1"), F.lit(0.0)).alias("token_f1"),
        F.count(F.lit(1)).alias("total_samples"))


def neighbour_f1(texts: DataFrame, key: str, text: str = "text", group=("run_id",)) -> DataFrame:
    """E3 of each text against the one whose integer ``key`` is one higher.  A text is tokenised
    once and its token set sent to both pairs it belongs to; no text is shuffled.  Keys are meant
    to be unique: the sets of a repeated key meet in one row, which forms all their pairs."""
    sets = texts.where(F.col(key).isNotNull()).select(*group, key, token_set(_c(text)).alias("_t"))
    both = F.array(F.struct(F.col(key).alias("_pair"), F.lit(True).alias("_p")),
                   F.struct((F.col(key) - 1).alias("_pair"), F.lit(False).alias("_p")))
    sent = sets.select(*group, "_t", F.inline(both))
    sides = sent.groupBy(*group, "_pair").agg(F.collect_list(F.when(F.col("_p"), F.struct("_t"))).alias("_ps"),
                                              F.collect_list(F.when(~F.col("_p"), F.struct("_t"))).alias("_rs"))
    # an inner generator would repeat the tokenising in a filter of its own
    pairs = sides.where((F.size("_ps") > 0) & (F.size("_rs") > 0)).select(*group, F.explode_outer("_ps").alias("_a"), "_rs")
    pairs = pairs.select(*group, F.col("_a._t").alias("_pt"), F.explode_outer("_rs").alias("_b")).select(*group, "_pt", F.col("_b._t").alias("_rt"))
    return _f1_of_sets(pairs, "_f1").groupBy(*group).agg(
        F.coalesce(F.avg("_f1"), F.lit(0.0)).alias("token_f1"), F.count(F.lit(1)).alias("total_samples"))


# ------------------------------------------------------------------ result comparison

def renumber(rows: DataFrame, keys=("query_id", "side"), order="row_idx", bounds: list | None = None) -> DataFrame:
    """Dense 1-based row positions per (query, side) in ``order``.  Range-partitioned
    (``ordering.positions_within``), so one huge result set is numbered by many tasks."""
    from .ordering import positions_within
    return positions_within(rows, keys, (order,), out="_pos", bounds=bounds).drop(order).withColumnRenamed("_pos", order)


def _canon_cells(cells: Column) -> Column:
    return F.transform(cells, lambda x: F.coalesce(x, F.lit(NULL_MARK)))


def compare_results(rows: DataFrame, ordered: bool = True, query="query_id") -> DataFrame:
    """Per query, do the 'ref' and 'pred' row lists agree?

    ``rows`` = (query_id, side, row_idx, cells array<string>) with cells already
    in canonical text form (NULL allowed, NaN as ``NAN_MARK``).  Ordered mode
    compares position by position (the reference's semantics); unordered mode
    compares multisets.  Output (query_id, rows_equal, n_ref, n_pred) for
    queries with at least one row; queries with no rows at all are equal.
    """
    cells = _canon_cells(F.col("cells"))
    has_nan = F.coalesce(F.exists(cells, lambda x: x == F.lit(NAN_MARK)), F.lit(False))
    base = rows.select(query, "side", "row_idx", cells.alias("cells"), has_nan.alias("nan"))
    if ordered:
        from . import ordering
        sizes = ordering.group_sizes(base, (query, "side"))
        bounds = ordering.slice_bounds(base, (query, "side"), ("row_idx",), sizes=sizes)
        # without large results, one exchange on the query serves the numbering and both aggregates;
        # its tasks grow in number, not in size
        parts = -(-sizes[1] // ordering.TASK_ROWS)
        base = renumber(base if bounds else ordering.spread(base, [query], parts), keys=(query, "side"), bounds=bounds)
        if bounds:
            base = ordering.spread(base, [query, "row_idx"], parts)
        ref = F.col("side") == "ref"
        j = base.groupBy(query, "row_idx").agg(
            F.max(F.when(ref, F.col("cells"))).alias("rc"), F.max(F.when(F.col("side") == "pred", F.col("cells"))).alias("pc"),
            F.max(F.when(ref, F.col("nan"))).alias("rn"))
        ok = F.coalesce((F.col("rc") == F.col("pc")) & ~F.col("rn"), F.lit(False))
        return j.groupBy(query).agg(
            F.bool_and(ok).alias("rows_equal"),
            F.count("rc").alias("n_ref"), F.count("pc").alias("n_pred"))
    # multiset: count identical rows per side, then compare counts
    g = base.groupBy(query, "cells").agg(
        F.count_if(F.col("side") == "ref").alias("cr"), F.count_if(F.col("side") == "pred").alias("cp"),
        F.max("nan").alias("nan"))
    ok = (F.col("cr") == F.col("cp")) & ~F.col("nan")
    return g.groupBy(query).agg(F.bool_and(ok).alias("rows_equal"),
                                F.sum("cr").alias("n_ref"), F.sum("cp").alias("n_pred"))


def execution_details(executions: DataFrame, comparison: DataFrame, query="query_id") -> DataFrame:
    """One row per query: executed flags, match flag, row count or error per side.

    ``executions`` = (query_id, side, exec_ok, error)."""
    side = F.col("side")
    ex = executions.groupBy(query).agg(
        F.max(F.when(side == "ref", F.col("exec_ok"))).alias("reference_executed"),
        F.max(F.when(side == "pred", F.col("exec_ok"))).alias("prediction_executed"),
        F.max(F.when(side == "ref", F.col("error"))).alias("ref_err"),
        F.max(F.when(side == "pred", F.col("error"))).alias("pred_err"))
    j = ex.join(comparison, query, "left")
    ref_ok = F.coalesce(F.col("reference_executed"), F.lit(False))
    pred_ok = F.coalesce(F.col("prediction_executed"), F.lit(False))
    match = ref_ok & pred_ok & F.coalesce(F.col("rows_equal"), F.lit(True))
    return j.select(
        query, ref_ok.alias("reference_executed"), pred_ok.alias("prediction_executed"),
        match.alias("results_match"),
        F.when(ref_ok, F.coalesce(F.col("n_ref"), F.lit(0))).alias("reference_result_count"),
        F.when(~ref_ok, F.col("ref_err")).alias("reference_error"),
        F.when(pred_ok, F.coalesce(F.col("n_pred"), F.lit(0))).alias("predicted_result_count"),
        F.when(~pred_ok, F.col("pred_err")).alias("prediction_error"))


def _rate(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def execution_rates(details: DataFrame, group=("run_id",)) -> DataFrame:
    """E5: reference ok, prediction ok, match over all, match over valid references."""
    n = F.count(F.lit(1))
    ref_ok = F.count_if("reference_executed")
    m = F.count_if("results_match")
    return details.groupBy(*group).agg(
        n.alias("total_samples"),
        _rate(ref_ok, n).alias("reference_execution_rate"),
        _rate(F.count_if("prediction_executed"), n).alias("prediction_execution_rate"),
        _rate(m, n).alias("execution_match_rate"),
        _rate(m, ref_ok).alias("execution_match_rate_of_valid"))


def execution_accuracy(details: DataFrame, group=("run_id",)) -> DataFrame:
    """Prediction success rate and result match rate."""
    n = F.count(F.lit(1))
    return details.groupBy(*group).agg(
        _rate(F.count_if("prediction_executed"), n).alias("execution_success_rate"),
        _rate(F.count_if("results_match"), n).alias("result_match_rate"))


def error_preview(details: DataFrame, run="run_id", order="query_id", k: int = 3) -> DataFrame:
    """Per run and side, when nothing succeeded, the first ``k`` failures;
    plus the first ``k`` samples of every run.  ``row_number() <= k`` is planned
    with a map-side group limit, so a huge run ships only ``k`` rows per task."""
    sides = details.select(run, order, F.lit("reference").alias("side"),
                           F.col("reference_executed").alias("ok"),
                           F.col("reference_error").alias("error")).unionByName(
        details.select(run, order, F.lit("prediction").alias("side"),
                       F.col("prediction_executed").alias("ok"),
                       F.col("prediction_error").alias("error")))
    zero = sides.groupBy(run, "side").agg(F.count_if("ok").alias("n_ok")).where(F.col("n_ok") == 0)
    fails = sides.join(zero.select(run, "side"), [run, "side"], "left_semi")
    w = Window.partitionBy(run, "side").orderBy(order)
    fail_rows = (fails.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)
                 .select(run, F.concat(F.lit("error:"), F.col("side")).alias("kind"), order, "rank", "error"))
    w2 = Window.partitionBy(run).orderBy(order)
    sample_rows = (details.withColumn("rank", F.row_number().over(w2).cast("bigint")).where(F.col("rank") <= k)
                   .select(run, F.lit("sample").alias("kind"), order, "rank",
                           F.lit(None).cast("string").alias("error")))
    return fail_rows.unionByName(sample_rows)


def eval_summary(text: DataFrame, rates: DataFrame, run="run_id") -> DataFrame:
    """Text metrics and execution rates side by side per run (either may be absent)."""
    t = text.withColumnRenamed("total_samples", "text_total_samples")
    r = rates.withColumnRenamed("total_samples", "exec_total_samples")
    return t.join(r, run, "full")
