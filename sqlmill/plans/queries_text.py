"""Queries for corpus parsing, text rules and dataset statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import parse, stats
from ..sources import fixtures
from ..sources.tables import table
from .oracle_base import D1, blank, strip  # noqa: F401
from .registry import register

# ---------------------------------------------------------------- parse_sharegpt

SHAREGPT_SQL = f"""
with g as (
 select conv_id, count(*) as n_turns,
  arg_max(coalesce(text, ''), turn) filter (where role in ('user', 'human')) as q,
  arg_max(coalesce(text, ''), turn) filter (where role in ('assistant', 'gpt')) as a
 from conversations group by conv_id)
select conv_id, {strip('q')} as question, {strip('a')} as sql from g
where n_turns >= 2 and not {blank(strip('q'))} and not {blank(strip('a'))}"""


def conversation_pairs(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return parse.parse_sharegpt_long(turns)


@register("parse_sharegpt", SHAREGPT_SQL)
def q_parse_sharegpt(spark, sf_dir):
    return conversation_pairs(spark, sf_dir)


# ---------------------------------------------------------------- dataset_stats

def _stats_sql(src: str, inp: str, out: str, group: str = "") -> str:
    u = f"upper({out})"
    verbs = ["SELECT", "INSERT", "UPDATE", "DELETE"]
    parts = [f"count(*) as total_samples"]
    for v in verbs:
        parts.append(f"count(*) filter (where starts_with({u}, '{v}')) as n_{v.lower()}")
    parts.append("count(*) filter (where not (" + " or ".join(f"starts_with({u}, '{v}')" for v in verbs)
                 + ")) as n_other")
    for name, subs in stats.FEATURES:
        cond = " or ".join(f"contains({u}, '{s}')" for s in subs)
        parts.append(f"count(*) filter (where {cond}) as {name}")
    parts.append(f"coalesce(avg(length({inp})), 0.0) as avg_input_length_raw")
    parts.append(f"coalesce(avg(length({out})), 0.0) as avg_output_length_raw")
    sel = (group + ", " if group else "") + ", ".join(parts)
    gb = f" group by {group}" if group else ""
    return (f"select *, round_even(avg_input_length_raw, 2) as avg_input_length, "
            f"round_even(avg_output_length_raw, 2) as avg_output_length from (select {sel} from {src}{gb})")


STATS_SQL = f"with p as ({SHAREGPT_SQL}) " + _stats_sql("p", "question", "sql")


@register("dataset_stats", STATS_SQL)
def q_dataset_stats(spark, sf_dir):
    """Flagship: chat corpus → (question, sql) pairs → one-pass statistics."""
    pairs = conversation_pairs(spark, sf_dir)
    return stats.dataset_stats(pairs, inp="question", out="sql")


SAMPLE_STATS_SQL = f"with {D1} " + _stats_sql("d1", "input", "output", "db_id")


@register("sample_stats", SAMPLE_STATS_SQL)
def q_sample_stats(spark, sf_dir):
    return stats.dataset_stats(fixtures.samples(spark, sf_dir), group=("db_id",))


def _pct_sql() -> str:
    unions = " union all ".join(
        f"select db_id, total_samples, '{c}' as stat, {c} as count from s" for c in stats.COUNT_COLUMNS)
    return (f"with {D1}, s as ({_stats_sql('d1', 'input', 'output', 'db_id')}), l as ({unions}) "
            "select db_id, stat, count, coalesce(case when total_samples = 0 then null "
            "else count / total_samples end * 100, 0.0) as pct from l")


@register("dataset_stats_pct", _pct_sql())
def q_dataset_stats_pct(spark, sf_dir):
    s = stats.dataset_stats(fixtures.samples(spark, sf_dir), group=("db_id",))
    return stats.dataset_stats_pct(s, group=("db_id",))


# ---------------------------------------------------------------- N1 / N3 / S4 / S5

ALPACA_CTE = """alp as (select 2 * d.doc_id + e.e as doc_id, concat('Write SQL for document ', cast(2 * d.doc_id + e.e as varchar), ' (', lang, ')  ') as instruction,
  case when e.e = 0 then text else '' end as input,
  concat(' SELECT ', cast(n_chars as varchar), ' FROM documents;', chr(10)) as output, lang
  from documents d cross join (values (0), (1)) e(e))"""
MIXED_CTE = ALPACA_CTE + """,
conv as (select conv_id, list(struct_pack(role := role, content := text) order by turn) as c from conversations group by conv_id),
mixed as (
 select concat('docs-', lang) as dataset_id, doc_id as ord, instruction, input, output, null::struct(role varchar, content varchar)[] as c from alp
 union all select 'chats', conv_id, null, null, null, c from conv)"""


def _alpaca_q(i="instruction", x="input"):
    """N1 question in SQL: strip(instruction + newline + input) when input is non-empty."""
    joined = strip(f"concat(coalesce({i}, ''), chr(10), {x})")
    alone = strip(f"coalesce({i}, '')")
    return f"case when coalesce({x}, '') <> '' then {joined} else {alone} end"


@register("parse_alpaca", f"""with {ALPACA_CTE}
select doc_id as ord, {_alpaca_q()} as question, {strip("coalesce(output, '')")} as sql from alp""")
def q_parse_alpaca(spark, sf_dir):
    a = fixtures.alpaca_rows(spark, sf_dir).withColumnRenamed("doc_id", "ord")
    return parse.parse_alpaca(a)


def _last_role(roles):
    r = ", ".join(f"'{x}'" for x in roles)
    return f"list_filter(c, lambda x: x.role in ({r}))[-1].content"


@register("parse_any", f"""with {MIXED_CTE},
f as (select *, case when c is not null then 'sharegpt' when instruction is not null then 'alpaca' end as format,
  {strip(f"coalesce({_last_role(parse.USER_ROLES)}, '')")} as sq, {strip(f"coalesce({_last_role(parse.ASSISTANT_ROLES)}, '')")} as sa
  from mixed)
select dataset_id, ord, format, case when format = 'sharegpt' then sq else {_alpaca_q()} end as question,
 case when format = 'sharegpt' then sa else {strip("coalesce(output, '')")} end as sql
from f where format is not null and (format <> 'sharegpt' or (coalesce(len(c), 0) >= 2 and sq <> '' and sa <> ''))""")
def q_parse_any(spark, sf_dir):
    return parse.parse_any(fixtures.mixed_corpus(spark, sf_dir), keys=("dataset_id", "ord"))


@register("bench_view", f"""with {MIXED_CTE},
f as (select *, case when c is not null then 'sharegpt' when instruction is not null then 'alpaca' end as format from mixed)
select dataset_id, ord, format,
 case when format = 'alpaca' then {strip("concat(coalesce(instruction, ''), ' ', coalesce(input, ''))")}
      else {strip("case when coalesce(len(c), 0) > 0 then coalesce(c[1].content, '') else '' end")} end as question,
 case when format = 'alpaca' then {strip("coalesce(output, '')")}
      else {strip("case when coalesce(len(c), 0) > 1 then coalesce(c[-1].content, '') else '' end")} end as reference
from f where format is not null""")
def q_bench_view(spark, sf_dir):
    return parse.bench_view(fixtures.mixed_corpus(spark, sf_dir), keys=("dataset_id", "ord"))


@register("detect_format", f"""with {MIXED_CTE}
select dataset_id, case when arg_min(c is not null, ord) then 'sharegpt' when arg_min(instruction is not null, ord)
 then 'alpaca' else 'unknown' end as format from mixed group by dataset_id""")
def q_detect_format(spark, sf_dir):
    return parse.detect_format(fixtures.mixed_corpus(spark, sf_dir))
