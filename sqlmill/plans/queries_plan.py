"""Queries for plan parsing, topic filtering and sample allocation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.jsontext import with_extracted_json
from ..operators import planning as P
from ..sources import fixtures
from .oracle_base import CATALOG, D4
from .registry import register

MIN_TABLES, MAX_TABLES = 2, 4

# oracle: the same responses, and what parsing them must give
PLANS = f"""{D4},
tj as (select plan_id, db_id, total, ord, concat('{{"name":"', name, '","tables":[',
   array_to_string(list_transform(tables, lambda t: concat('"', t, '"')), ','), '],"reason":"r', cast(ord as varchar),
   '","count":', cast(cnt as varchar), ',"dialect":"mysql"}}') as o from d4),
pl as (select plan_id, db_id, total, string_agg(o, ',' order by ord) as body from tj group by all),
pr as (select plan_id, db_id, total, body, concat('{{"topics":[', body, ']}}') as obj from pl),
resp as (select *, case when plan_id % 5 = 0 then obj
   when plan_id % 5 = 1 then concat('Plan below.', chr(10), '```json', chr(10), obj, chr(10), '```')
   when plan_id % 5 = 2 then concat('Here you go: ', obj, ' hope it helps')
   when plan_id % 5 = 3 then concat('```', chr(10), '[', body, ']', chr(10), '```')
   when plan_id % 10 = 4 then concat('```json', chr(10), '{{"topics":[', body, chr(10), '```')
   else concat('{{"plan":[', body, ']}}') end as response,
  case when plan_id % 5 in (0, 1, 2) then obj when plan_id % 5 = 3 then concat('[', body, ']')
   when plan_id % 10 = 9 then concat('{{"plan":[', body, ']}}') end as json,
  case when plan_id % 10 = 4 then 'invalid JSON in fence' end as error from pr),
good as (select plan_id from resp where plan_id % 5 <> 4),
topics as (select d4.plan_id, d4.db_id, d4.total, d4.name, d4.tables, d4.cnt as count,
   row_number() over (partition by d4.plan_id order by d4.ord) - 1 as ord
   from d4 semi join good on d4.plan_id = good.plan_id)"""


def _parsed(spark, sf_dir):
    r = fixtures.plan_responses(spark, sf_dir)
    rows, errors = P.parse_plans(r)
    meta = r.select("plan_id", "db_id", "total")
    return r, rows.join(meta, "plan_id"), errors


@register("extract_json", f"with {PLANS} select plan_id, json, error from resp")
def q_extract_json(spark, sf_dir):
    r = fixtures.plan_responses(spark, sf_dir)
    return with_extracted_json(r, "response").select("plan_id", "x.json", "x.error")


@register("plan_rows", f"""with {PLANS} select plan_id, ord, name, array_to_string(tables, ',') as tables, count
 from topics""")
def q_plan_rows(spark, sf_dir):
    _, rows, _ = _parsed(spark, sf_dir)
    return rows.select("plan_id", "ord", "name", F.array_join("tables", ",").alias("tables"), "count")


VALID = f"""{PLANS}, {CATALOG},
ctabs as (select distinct db_id, table_name from catalog_columns),
ex as (select plan_id, ord, db_id, unnest(tables) as table_name, generate_subscripts(tables, 1) as i from topics),
kept as (select plan_id, ord, list(table_name order by i) as vt from ex semi join ctabs using (db_id, table_name) group by all),
valid as (select t.plan_id, t.ord, t.name, t.total, t.count, vt[1:{MAX_TABLES}] as tables
  from topics t join kept k using (plan_id, ord) where len(vt) >= {MIN_TABLES})"""


def _valid(spark, sf_dir):
    r, rows, errors = _parsed(spark, sf_dir)
    cat = fixtures.catalog_columns(spark, sf_dir).select("db_id", "table_name")
    return r, P.filter_topics(rows, cat, MIN_TABLES, MAX_TABLES), errors


@register("plan_filter", f"""with {VALID} select plan_id, ord, name, array_to_string(tables, ',') as tables from valid""")
def q_plan_filter(spark, sf_dir):
    _, v, _ = _valid(spark, sf_dir)
    return v.select("plan_id", "ord", "name", F.array_join("tables", ",").alias("tables"))


@register("plan_errors", f"""with {VALID}
select plan_id, case when plan_id % 10 = 4 then 'invalid JSON in fence' else '{P.E_FORMAT}' end as error
 from resp where plan_id % 5 = 4
union all
select plan_id, '{P.E_NO_TOPIC}' from resp where plan_id % 5 <> 4 and plan_id not in (select plan_id from valid)""")
def q_plan_errors(spark, sf_dir):
    r, v, errors = _valid(spark, sf_dir)
    return P.plan_errors(r, v, errors)


ALLOC = f"""{VALID},
pv as (select *, row_number() over (partition by plan_id order by ord) as rn,
  sum(count) over (partition by plan_id) as cur from valid),
capped as (select *, count(*) over (partition by plan_id) as n,
  case when cur > 0 then total / cur else 1.0 end as ratio from pv where rn <= greatest(1, total)),
alloc as (
  select plan_id, ord, rn, n, ratio, total, cur,
   case when 1 < n then least(greatest(1, round_even(count * ratio, 0)::bigint), total - (n - 1)) else greatest(1, total) end as c
  from capped where rn = 1),
rec as (
  select plan_id, rn, ord, c, total - c as rem from alloc
  union all
  select x.plan_id, x.rn, x.ord,
   case when x.rn < x.n then least(greatest(1, round_even(x.count * x.ratio, 0)::bigint), rec.rem - (x.n - x.rn))
        else greatest(1, rec.rem) end,
   rec.rem - case when x.rn < x.n then least(greatest(1, round_even(x.count * x.ratio, 0)::bigint), rec.rem - (x.n - x.rn))
        else greatest(1, rec.rem) end
  from rec join capped x on x.plan_id = rec.plan_id and x.rn = rec.rn + 1),
final as (
  select plan_id, ord, count from pv where cur = total
  union all
  select rec.plan_id, rec.ord, rec.c::double from rec join (select distinct plan_id, cur, total from pv) p
   on rec.plan_id = p.plan_id where p.cur <> p.total)"""


def allocation(spark, sf_dir):
    r, v, _ = _valid(spark, sf_dir)
    return P.allocate_samples(v, r.select("plan_id", "total"))


@register("allocate_samples", f"with recursive {ALLOC} select plan_id, ord, count from final")
def q_allocate_samples(spark, sf_dir):
    return allocation(spark, sf_dir)


@register("topic_targets", f"""with recursive {ALLOC}
select plan_id, ord, round_even(count, 0)::bigint as target from final where round_even(count, 0) <> 0""")
def q_topic_targets(spark, sf_dir):
    return P.topic_targets(allocation(spark, sf_dir))


@register("plan_json", f"""with recursive {ALLOC},
doc as (select final.plan_id, final.ord, struct_pack(name := d.name, tables := v.tables, reason := concat('r', cast(d.ord as varchar)),
   count := round_even(final.count, 0)::bigint, dialect := 'mysql') as topic
  from final join valid v using (plan_id, ord)
  join (select plan_id, ord, name, row_number() over (partition by plan_id order by ord) - 1 as place from d4) d
    on d.plan_id = final.plan_id and d.place = final.ord)
select plan_id, concat('{{"topics":', to_json(list(topic order by ord))::varchar, '}}') as plan_json from doc group by plan_id""")
def q_plan_json(spark, sf_dir):
    r, v, _ = _valid(spark, sf_dir)
    return P.plan_json(v, P.allocate_samples(v, r.select("plan_id", "total")))
