"""Queries for prompts, model calls and generated samples."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..operators import catalog as cat
from ..operators import generation as G
from ..operators import prompts as PR
from ..sources import fixtures
from ..sources.tables import table
from .oracle_base import D2, D4, q, strip
from .queries_catalog import BASE, assembled
from .queries_text import SHAREGPT_SQL, conversation_pairs
from .registry import register


def render_sql(template: str, **exprs) -> str:
    parts, last = [], 0
    for m in re.finditer(r"\$\{(\w+)\}", template):
        if m.start() > last:
            parts.append(q(template[last:m.start()]))
        parts.append(f"cast({exprs[m.group(1)]} as varchar)")
        last = m.end()
    if last < len(template):
        parts.append(q(template[last:]))
    return "concat(" + ", ".join(parts) + ")"


@register("build_prompt", f"""with p as ({SHAREGPT_SQL})
select conv_id, {render_sql(PR.TRAIN_TEMPLATE, system=q(PR.SYSTEM_PROMPT), question='question', sql='sql')} as prompt from p""")
def q_build_prompt(spark, sf_dir):
    p = conversation_pairs(spark, sf_dir)
    return p.select("conv_id", PR.build_prompt("question", "sql").alias("prompt"))


@register("inference_prompt", f"""select item_id,
 {render_sql(PR.INFER_TEMPLATE, system=q(PR.SYSTEM_PROMPT), question='text')} as prompt from benchmark""")
def q_inference_prompt(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark", "item_id", "text")
    return b.select("item_id", PR.build_prompt("text", training=False).alias("prompt"))


@register("build_chat_prompt", f"""select item_id, 0 as msg, 'system' as role, {q(PR.CHAT_SYSTEM_PROMPT)} as content from benchmark
union all select item_id, 1, 'user', text from benchmark""")
def q_build_chat_prompt(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark", "item_id", "text")
    m = b.select("item_id", F.posexplode(PR.build_chat_prompt("text")).alias("msg", "m"))
    return m.select("item_id", "msg", "m.role", "m.content")


PLAN_PARAMS = dict(min_tables=3, max_tables=8, dialect="mysql")


@register("planning_prompt", BASE + f""",
ct as (select db_id, string_agg(block, chr(10) order by table_name) as cards from blocks group by db_id)
select db_id, {render_sql(PR.PLANNING_TEMPLATE, cards='cards', total='db_id % 60 + 1', min_tables='3',
                          max_tables='8', dialect=q('mysql'))} as prompt from ct""")
def q_planning_prompt(spark, sf_dir):
    ct = cat.cards_text(cat.table_cards(assembled(spark, sf_dir)))
    return ct.select("db_id", PR.planning_prompt(F.col("cards_text"), F.col("db_id") % 60 + 1,
                                                 **PLAN_PARAMS).alias("prompt"))


GEN_PROMPT_SQL = BASE + f""", {D4},
t as (select plan_id, ord, db_id, unnest(tables) as table_name, generate_subscripts(tables, 1) as i from d4),
g as (select plan_id, ord, string_agg(b.ddl, chr(10) order by t.i) as ddl from t join blocks b using (db_id, table_name) group by all),
x as (select d4.*, coalesce(g.ddl, '') as ddl from d4 left join g using (plan_id, ord))
select plan_id, ord, {render_sql(PR.GENERATION_TEMPLATE, topic='name', ddl='ddl', count='round_even(cnt, 0)::bigint',
                                 dialect=q('mysql'))} as prompt from x"""


def generation_prompts(spark, sf_dir):
    topics = fixtures.topics(spark, sf_dir)
    ddl = cat.topic_ddl(topics, cat.table_ddl(assembled(spark, sf_dir)))
    j = topics.join(ddl, ["plan_id", "ord"])
    return j.select("plan_id", "ord", PR.generation_prompt(
        F.col("name"), F.col("ddl"), F.bround("cnt", 0).cast("bigint"), "mysql").alias("prompt"))


@register("generation_prompt", GEN_PROMPT_SQL)
def q_generation_prompt(spark, sf_dir):
    return generation_prompts(spark, sf_dir)


def stand_in_model(prompts):
    """Deterministic stand-in for a model endpoint: answers each generation
    prompt with one JSON line per requested sample."""
    out = []
    for p in prompts:
        m = re.search(r"生成 (\d+) 条关于\"(.*?)\"主题", p)
        n, topic = (int(m.group(1)), m.group(2)) if m else (1, "?")
        out.append("\n".join('{"input":"%s question %d","output":"SELECT %d;"}' % (topic, i, i) for i in range(n)))
    return out


STAND_IN_SQL = GEN_PROMPT_SQL.rsplit("select plan_id, ord,", 1)[0] + """select plan_id, ord,
 array_to_string(list_transform(range(round_even(cnt, 0)::bigint), lambda i: concat('{"input":"', name, ' question ',
   cast(i as varchar), '","output":"SELECT ', cast(i as varchar), ';"}')), chr(10)) as response,
 null::varchar as error, 1 as attempts from x"""


@register("batch_inference", STAND_IN_SQL)
def q_batch_inference(spark, sf_dir):
    """G1 with the deterministic stand-in model over every topic's generation prompt."""
    p = generation_prompts(spark, sf_dir)
    return G.batch_inference(p, stand_in_model, keys=("plan_id", "ord"), base_wait=0.0)


# ---------------------------------------------------------------- N11, G3-G5 on D2 responses

PARSE_SQL = f"""with {D2},
sp as (select db_id, topic_id, target, string_split({strip('response')}, chr(10)) as ls from d2),
l as (select db_id, topic_id, target, unnest(ls) as raw, generate_subscripts(ls, 1) - 1 as line_no from sp),
l2 as (select *, {strip('raw')} as line from l),
s as (select db_id, topic_id, target, line_no, {strip("json_extract_string(line, '$.input')")} as input,
  {strip("json_extract_string(line, '$.output')")} as output from l2
  where not (line = '' or starts_with(line, '#') or starts_with(line, '//'))
   and json_valid(line) and json_type(line) = 'OBJECT'
   and json_type(line, '$.input') = 'VARCHAR' and json_type(line, '$.output') = 'VARCHAR')"""


def d2_samples(spark, sf_dir):
    r = fixtures.responses(spark, sf_dir)
    s, _ = G.parse_samples(r, keys=("db_id", "topic_id"))
    return r, s


@register("parse_samples", PARSE_SQL + " select db_id, topic_id, line_no, input, output from s")
def q_parse_samples(spark, sf_dir):
    return d2_samples(spark, sf_dir)[1]


@register("topic_shortfall", PARSE_SQL + """, n as (select topic_id, count(*) as n from s group by topic_id)
select d2.topic_id, d2.target, coalesce(n.n, 0) as n_samples, greatest(d2.target - coalesce(n.n, 0), 0) as shortfall
from d2 left join n using (topic_id)""")
def q_topic_shortfall(spark, sf_dir):
    r, s = d2_samples(spark, sf_dir)
    return G.topic_shortfall(s, r, keys=("topic_id",))


@register("cap_per_topic", PARSE_SQL + """
select topic_id, line_no, input, output from
 (select *, row_number() over (partition by topic_id order by line_no) as rn from s) where rn <= target""")
def q_cap_per_topic(spark, sf_dir):
    r, s = d2_samples(spark, sf_dir)
    c = G.cap_per_topic(s.withColumn("pass", F.lit(1)), r, keys=("topic_id",))
    return c.select("topic_id", "line_no", "input", "output")


@register("union_topics", PARSE_SQL + """,
n as (select topic_id, count(*) as n from s group by topic_id),
top as (select s.* from s join d2 using (topic_id) left join n using (topic_id) where d2.target > coalesce(n.n, 0)),
u as (select topic_id, target, 1 as pass, line_no, input, output from s
      union all select topic_id, target, 2, line_no, input, output from top)
select topic_id, pass, line_no, input, output from
 (select *, row_number() over (partition by topic_id order by pass, line_no) as rn from u) where rn <= target""")
def q_union_topics(spark, sf_dir):
    r, s = d2_samples(spark, sf_dir)
    short = G.topic_shortfall(s, r, keys=("topic_id",)).where("shortfall > 0")
    # the top-up answer: the same deterministic model output, asked again
    top_resp = r.join(short.select("topic_id"), "topic_id", "left_semi")
    top, _ = G.parse_samples(top_resp, keys=("db_id", "topic_id"))
    u = G.union_topics(s, top, r, keys=("topic_id",))
    return u.select("topic_id", "pass", "line_no", "input", "output")
