"""Queries for text metrics, execution results and evaluation reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import extend
from ..functions.sqltext import (FENCE_ANY_RE2, FENCE_SQL_RE2, extract_sql, limit_probe_sql,
                                 normalize_sql, select_gate)
from ..operators import evaluation as ev
from ..operators.execution import canonical_cell
from ..sources import fixtures
from ..sources.tables import table
from .oracle_base import (D3, D5, KW_LIST, LEX_LIT, PAIRS, WS_RE, q, strip, tokens)
from .queries_text import SHAREGPT_SQL, conversation_pairs
from .registry import register


def norm_sql(x: str) -> str:
    mapped = (f"list_transform(regexp_extract_all({x}, {LEX_LIT}), lambda t: case when starts_with(t, '--') "
              f"or starts_with(t, '/*') then ' ' when list_contains({KW_LIST}, upper(t)) then lower(t) else t end)")
    return strip(f"regexp_replace(array_to_string({mapped}, ''), {WS_RE} || '+', ' ', 'g')")


def f1_sql(p: str, r: str) -> str:
    """Token F1 of two text expressions, as DuckDB SQL."""
    pt, rt = tokens(p), tokens(r)
    c = f"len(list_intersect({pt}, {rt}))::double"
    npr, nrr = f"len({pt})::double", f"len({rt})::double"
    prec, rec = f"({c} / {npr})", f"({c} / {nrr})"
    return (f"case when {npr} = 0 or {nrr} = 0 or {c} = 0 then 0.0::double "
            f"else 2.0::double * {prec} * {rec} / ({prec} + {rec}) end")


def extract_sql_sql(t: str) -> str:
    return (
        f"case when contains(lower({t}), '```sql') and regexp_matches({t}, {q(FENCE_SQL_RE2)}) "
        f"then {strip(f'regexp_extract({t}, {q(FENCE_SQL_RE2)}, 1)')} "
        f"when contains({t}, '```') and regexp_matches({t}, {q(FENCE_ANY_RE2)}) "
        f"then {strip(f'regexp_extract({t}, {q(FENCE_ANY_RE2)}, 1)')} "
        f"else null end")


# ---------------------------------------------------------------- N8 extract_sql

EXTRACT_SQL = f"""
with {D3},
l as (select doc_id, model_text, list_transform(string_split(model_text, chr(10)), lambda x: {strip('x')}) as lines from d3),
s as (select *, list_filter(range(1, len(lines) + 1), lambda i: starts_with(upper(lines[i]), 'SELECT'))[1] as s from l),
e as (select *, coalesce(list_filter(range(s, len(lines) + 1), lambda i: ends_with(lines[i], ';'))[1], len(lines)) as e from s)
select doc_id, coalesce({extract_sql_sql('model_text')},
  case when s is not null then array_to_string(lines[s:e], ' ') else {strip('model_text')} end) as sql
from e"""


@register("extract_sql", EXTRACT_SQL)
def q_extract_sql(spark, sf_dir):
    d = fixtures.model_texts(spark, sf_dir)
    return d.select("doc_id", extract_sql("model_text").alias("sql"))


# ---------------------------------------------------------------- N9 normalize_sql

NORMALIZE = f"with {PAIRS} select ord as sample_id, {norm_sql('reference')} as normalized, {norm_sql('prediction')} as normalized_prediction from pairs"


@register("normalize_sql", NORMALIZE)
def q_normalize_sql(spark, sf_dir):
    p = fixtures.prediction_pairs(spark, sf_dir)
    return p.select(F.col("ord").alias("sample_id"), normalize_sql("reference").alias("normalized"),
                    normalize_sql("prediction").alias("normalized_prediction"))


# ---------------------------------------------------------------- E1 / E2 / E3

EXACT = f"""with {PAIRS}
select run_id, coalesce(avg(case when {norm_sql('prediction')} = {norm_sql('reference')} then 1.0 else 0.0 end)::double, 0.0) as exact_match,
 count(*) as total_samples from pairs group by run_id"""


@register("exact_match", EXACT)
def q_exact_match(spark, sf_dir):
    return ev.exact_match(fixtures.prediction_pairs(spark, sf_dir))


TOKEN_F1 = f"with {PAIRS} select run_id, ord, {f1_sql('prediction', 'reference')} as f1 from pairs"


@register("token_f1", TOKEN_F1)
def q_token_f1(spark, sf_dir):
    p = fixtures.prediction_pairs(spark, sf_dir)
    return ev.with_token_f1(p).select("run_id", "ord", "f1")


TEXT_METRICS = f"""with {PAIRS}
select run_id,
 coalesce(avg(case when {norm_sql('prediction')} = {norm_sql('reference')} then 1.0 else 0.0 end)::double, 0.0) as exact_match,
 coalesce(avg({f1_sql('prediction', 'reference')}), 0.0) as token_f1, count(*) as total_samples
from pairs group by run_id"""


@register("text_metrics", TEXT_METRICS)
def q_text_metrics(spark, sf_dir):
    return ev.text_metrics(fixtures.prediction_pairs(spark, sf_dir))


TEXT_DETAILS = f"""with {PAIRS}
select run_id, ord, {strip('question')} as question, {strip('reference')} as reference, {strip('prediction')} as prediction,
 {norm_sql('prediction')} = {norm_sql('reference')} as exact_match from pairs"""


@register("text_match_details", TEXT_DETAILS)
def q_text_match_details(spark, sf_dir):
    return ev.text_match_details(fixtures.prediction_pairs(spark, sf_dir))


AVG_F1 = f"""with p as ({SHAREGPT_SQL}),
x as (
 select 'conversations' as run_id, sql as prediction, question as reference from p
 union all
 select 'documents', a.text, b.text from documents a join documents b on b.doc_id = a.doc_id + 1)
select run_id, coalesce(avg({f1_sql('prediction', 'reference')}), 0.0) as token_f1, count(*) as total_samples
from x group by run_id"""


@register("avg_token_f1", AVG_F1)
def q_avg_token_f1(spark, sf_dir):
    """Bench flagship: mean token F1 over whole texts: each chat's answer against its question, and
    each document against the next one."""
    chats = conversation_pairs(spark, sf_dir).select(
        F.lit("conversations").alias("run_id"), F.col("sql").alias("prediction"), F.col("question").alias("reference"))
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("run_id", F.lit("documents"))
    return ev.avg_token_f1(chats).unionByName(ev.neighbour_f1(docs, "doc_id"))


# ---------------------------------------------------------------- J1 / F1 / F3 / V8

ALIGN = """
with k as (select o_custkey % 20 as run_id, o_orderkey as ord, o_orderstatus as st from orders),
p as (select run_id, ord from k where st <> 'P'), r as (select run_id, ord from k where st <> 'F'),
j as (select coalesce(p.run_id, r.run_id) as run_id, p.ord is not null as hp, r.ord is not null as hr
      from p full join r on p.run_id = r.run_id and p.ord = r.ord)
select run_id, count(*) filter (where hp and hr) as n_pairs, count(*) filter (where not hr) as n_pred_only,
 count(*) filter (where not hp) as n_ref_only from j group by run_id"""


@register("align_pairs", ALIGN)
def q_align_pairs(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    k = o.select((F.col("o_custkey") % 20).alias("run_id"), F.col("o_orderkey").alias("ord"), "o_orderstatus")
    preds = k.where(F.col("o_orderstatus") != "P").drop("o_orderstatus")
    refs = k.where(F.col("o_orderstatus") != "F").drop("o_orderstatus")
    return ev.alignment_report(preds, refs)


FIRST_N = f"with {PAIRS} select * from pairs order by ord limit 100"


@register("first_n", FIRST_N)
def q_first_n(spark, sf_dir):
    return ev.first_n(fixtures.prediction_pairs(spark, sf_dir), 100)


def _probe_sql(x: str) -> str:
    t = strip(x)
    gate = f"starts_with(upper({t}), 'SELECT')"
    nosemi = f"case when ends_with({t}, ';') then left({t}, length({t}) - 1) else {t} end"
    return (f"case when {gate} then (case when contains(upper({t}), 'LIMIT') then {t} "
            f"else concat({nosemi}, ' LIMIT 1') end) end")


PROBE = f"""with {PAIRS} select ord as sample_id, starts_with(upper({strip('prediction')}), 'SELECT') as runnable,
 {_probe_sql('prediction')} as probe_sql from pairs"""


@register("limit_probe_sql", PROBE)
def q_limit_probe_sql(spark, sf_dir):
    p = fixtures.prediction_pairs(spark, sf_dir)
    return p.select(F.col("ord").alias("sample_id"), select_gate("prediction").alias("runnable"),
                    limit_probe_sql("prediction").alias("probe_sql"))


# ---------------------------------------------------------------- J10 / E4-E8

def result_cells(spark, sf_dir):
    r = fixtures.result_rows(spark, sf_dir)
    return r.select("query_id", "side", "row_idx", F.array("c1", "c2").alias("cells"))


COMPARE = f"""with {D5},
n as (select query_id, side, row_number() over (partition by query_id, side order by row_idx) as row_idx,
  [coalesce(c1, '~'), coalesce(c2, '~')] as cells from d5),
ref as (select query_id, row_idx, cells as rc from n where side = 'ref'),
pred as (select query_id, row_idx, cells as pc from n where side = 'pred'),
j as (select coalesce(ref.query_id, pred.query_id) as query_id, rc, pc from ref full join pred
      on ref.query_id = pred.query_id and ref.row_idx = pred.row_idx)
select query_id, bool_and(coalesce(rc = pc, false)) as rows_equal, count(rc) as n_ref, count(pc) as n_pred
from j group by query_id"""


@register("compare_results", COMPARE)
def q_compare_results(spark, sf_dir):
    return ev.compare_results(result_cells(spark, sf_dir), ordered=True)


COMPARE_MULTI = f"""with {D5},
g as (select query_id, [c1, c2] as cells, count(*) filter (where side = 'ref') as cr,
  count(*) filter (where side = 'pred') as cp from d5 group by query_id, [c1, c2])
select query_id, bool_and(cr = cp) as rows_equal, sum(cr)::bigint as n_ref, sum(cp)::bigint as n_pred
from g group by query_id"""


@register("compare_results_multiset", COMPARE_MULTI)
def q_compare_results_multiset(spark, sf_dir):
    return ev.compare_results(result_cells(spark, sf_dir), ordered=False)


def details_df(spark, sf_dir):
    cmp = ev.compare_results(result_cells(spark, sf_dir), ordered=True)
    return ev.execution_details(fixtures.executions(spark, sf_dir), cmp)


DETAILS_CTE = f"""{D5},
n as (select query_id, side, row_number() over (partition by query_id, side order by row_idx) as row_idx,
  [c1, c2] as cells from d5),
ref as (select query_id, row_idx, cells as rc from n where side = 'ref'),
pred as (select query_id, row_idx, cells as pc from n where side = 'pred'),
j as (select coalesce(ref.query_id, pred.query_id) as query_id, rc, pc from ref full join pred
      on ref.query_id = pred.query_id and ref.row_idx = pred.row_idx),
c as (select query_id, bool_and(coalesce(rc = pc, false)) as rows_equal, count(rc) as n_ref, count(pc) as n_pred
      from j group by query_id),
x as (select query_id,
  max(exec_ok) filter (where side = 'ref') as re, max(exec_ok) filter (where side = 'pred') as pe,
  max(error) filter (where side = 'ref') as rerr, max(error) filter (where side = 'pred') as perr
  from e5 group by query_id),
details as (
 select x.query_id, coalesce(re, false) as reference_executed, coalesce(pe, false) as prediction_executed,
  coalesce(re, false) and coalesce(pe, false) and coalesce(rows_equal, true) as results_match,
  case when coalesce(re, false) then coalesce(n_ref, 0) end as reference_result_count,
  case when not coalesce(re, false) then rerr end as reference_error,
  case when coalesce(pe, false) then coalesce(n_pred, 0) end as predicted_result_count,
  case when not coalesce(pe, false) then perr end as prediction_error
 from x left join c on x.query_id = c.query_id)"""


@register("execution_details", f"with {DETAILS_CTE} select * from details")
def q_execution_details(spark, sf_dir):
    return details_df(spark, sf_dir)


def _rates_sql(group: str) -> str:
    return f"""with {DETAILS_CTE}
select {group} as run_id, count(*) as total_samples,
 count(*) filter (where reference_executed) / count(*) as reference_execution_rate,
 count(*) filter (where prediction_executed) / count(*) as prediction_execution_rate,
 count(*) filter (where results_match) / count(*) as execution_match_rate,
 coalesce(count(*) filter (where results_match) / nullif(count(*) filter (where reference_executed), 0), 0.0)
   as execution_match_rate_of_valid
from details group by {group}"""


@register("execution_rates", _rates_sql("query_id % 20"))
def q_execution_rates(spark, sf_dir):
    d = details_df(spark, sf_dir).withColumn("run_id", F.col("query_id") % 20)
    return ev.execution_rates(d)


@register("execution_accuracy", f"""with {DETAILS_CTE}
select query_id % 20 as run_id, count(*) filter (where prediction_executed) / count(*) as execution_success_rate,
 count(*) filter (where results_match) / count(*) as result_match_rate from details group by query_id % 20""")
def q_execution_accuracy(spark, sf_dir):
    d = details_df(spark, sf_dir).withColumn("run_id", F.col("query_id") % 20)
    return ev.execution_accuracy(d)


PREVIEW = f"""with {DETAILS_CTE},
d as (select query_id % 11 as run_id, * from details),
s as (select run_id, query_id, 'reference' as side, reference_executed as ok, reference_error as error from d
      union all select run_id, query_id, 'prediction', prediction_executed, prediction_error from d),
z as (select run_id, side from s group by run_id, side having count(*) filter (where ok) = 0),
f as (select s.*, row_number() over (partition by s.run_id, s.side order by query_id) as rank
      from s semi join z on s.run_id = z.run_id and s.side = z.side)
select run_id, concat('error:', side) as kind, query_id, rank, error from f where rank <= 3
union all
select run_id, 'sample', query_id, rank, null from
 (select run_id, query_id, row_number() over (partition by run_id order by query_id) as rank from d) where rank <= 3"""


@register("error_preview", PREVIEW)
def q_error_preview(spark, sf_dir):
    d = details_df(spark, sf_dir).withColumn("run_id", F.col("query_id") % 11)
    return ev.error_preview(d)


def _summary_sql() -> str:
    rates = _rates_sql("query_id % 20")
    text = f"""select run_id,
 coalesce(avg(case when {norm_sql('prediction')} = {norm_sql('reference')} then 1.0 else 0.0 end)::double, 0.0) as exact_match,
 coalesce(avg({f1_sql('prediction', 'reference')}), 0.0) as token_f1, count(*) as text_total_samples
 from pairs group by run_id"""
    return (f"with {PAIRS}, t as ({text}), r as (select * exclude (total_samples), total_samples as exec_total_samples "
            f"from ({rates})) select coalesce(t.run_id, r.run_id) as run_id, t.* exclude (run_id), "
            f"r.* exclude (run_id) from t full join r on t.run_id = r.run_id")


@register("eval_summary", _summary_sql())
def q_eval_summary(spark, sf_dir):
    text = ev.text_metrics(fixtures.prediction_pairs(spark, sf_dir))
    d = details_df(spark, sf_dir).withColumn("run_id", F.col("query_id") % 20)
    return ev.eval_summary(text, ev.execution_rates(d))


@register("compare_typed_cells", """
select l_orderkey as query_id, l_orderkey % 3 <> 0 and bool_and(l_quantity = floor(l_quantity)) as rows_equal, count(*) as n_ref, count(*) as n_pred
from lineitem group by l_orderkey""")
def q_compare_typed_cells(spark, sf_dir):
    """J10 on typed cells: each order's lines against the same values in other types (numbers are equal by
    value across types, a date is never equal to its text, which every third order has)."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity", "l_returnflag", "l_shipdate")

    def side(name: str, **columns):
        typed = li.select(*[c.alias(n) for n, c in columns.items()])
        cells = F.array(*[canonical_cell(F.col(f.name), f.dataType) for f in typed.schema.fields if f.name != "query_id"])
        return typed.select("query_id", F.lit(name).alias("side"), F.lit(0).cast("bigint").alias("row_idx"), cells.alias("cells"))
    key, day = F.col("l_orderkey"), F.col("l_shipdate").cast("date")
    ref = side("ref", query_id=key, k=key, q=F.col("l_quantity"), f=F.col("l_returnflag"), d=day)
    same = side("pred", query_id=key, k=key.cast("decimal(20,2)"), q=F.col("l_quantity").cast("int"), f=F.col("l_returnflag"), d=day)
    text = side("pred", query_id=key, k=key.cast("double"), q=F.col("l_quantity").cast("decimal(10,1)"), f=F.col("l_returnflag"), d=day.cast("string"))
    rows = ref.unionByName(same.where("query_id % 3 <> 0")).unionByName(text.where("query_id % 3 = 0"))
    return ev.compare_results(rows, ordered=False)


@register("sql_functions", f"""with {PAIRS} select ord as sample_id, {norm_sql('prediction')} as normalized, {_probe_sql('prediction')} as probe_sql,
 {f1_sql('prediction', 'reference')} as f1, concat('Q: ', question, chr(10), 'A: ', reference) as prompt,
 case when contains(upper(prediction), 'SELECT *') then 'name the columns' end as message from pairs""")
def q_sql_functions(spark, sf_dir):
    """N9, V8, E2, a prompt template and a validation rule, all called from SQL."""
    extend.register_functions(spark)
    extend.register_template(spark, "example_prompt", "Q: {question}\nA: {reference}")
    extend.register_rule(spark, "no_star", "contains(upper(sql), 'SELECT *')", "name the columns")
    return spark.sql("""select ord as sample_id, normalize_sql(prediction) as normalized, limit_probe_sql(prediction) as probe_sql,
        token_f1(prediction, reference) as f1, example_prompt(question, reference) as prompt, no_star(prediction) as message
        from {pairs}""", pairs=fixtures.prediction_pairs(spark, sf_dir))
