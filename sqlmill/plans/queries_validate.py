"""Queries for SQL validation against catalogs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import SQL_KEYWORDS, WORD_RE
from ..operators import binding
from ..operators import validation as V
from ..session import persist_once
from ..sources import fixtures
from .oracle_base import CATALOG, D1, LEX_LIT, WS_RE, blank, q, strip
from .registry import register


def _lst(xs) -> str:
    return "[" + ", ".join(q(x) for x in xs) + "]"


def validation_sql(final: str, strict: bool = False) -> str:
    """The validator as DuckDB SQL; ``final`` selects from the CTEs."""
    leads = ",\n  ".join(
        f"lead(tok, {i}) over w as n{i}, lead(kw, {i}) over w as n{i}_up, "
        f"coalesce(lead(is_id, {i}) over w, false) as n{i}_id, lead(name, {i}) over w as n{i}_name"
        for i in (1, 2, 3, 4))
    not_bound = "" if strict else " and not exists (select 1 from bn where bn.sample_id = {t}.sample_id and bn.bound = {t}.table_name)"
    return f"""with {D1}, {CATALOG},
base as (select sample_id, db_id, output from d1 where not {blank('output')}),
lx as (select sample_id, db_id, regexp_extract_all({strip('output')}, {LEX_LIT}) as toks from base),
raw as (select sample_id, db_id, unnest(toks) as tok, unnest(range(len(toks))) as pos from lx),
tk as (select sample_id, db_id, pos, tok, upper(tok) as up, regexp_full_match(tok, {q(WORD_RE)}) as is_word,
  (starts_with(tok, '"') or starts_with(tok, '`')) and length(tok) >= 2 as qid
  from raw where not regexp_matches(tok, '^' || {WS_RE}) and not starts_with(tok, '--') and not starts_with(tok, '/*')),
tk2 as (select *, (is_word and not list_contains({_lst(SQL_KEYWORDS)}, up) and not regexp_matches(tok, '^[0-9]')) or qid as is_id,
  case when qid then substring(lower(tok), 2, length(tok) - 2) else lower(tok) end as name,
  case when tok = '(' then 1 when tok = ')' then -1 else 0 end as delta from tk),
tk3 as (select *, lag(up, 1) over w as u1, lag(up, 2) over w as u2 from tk2 window w as (partition by sample_id order by pos)),
tk4 as (select * exclude (u1, u2), case when up = 'FROM' and u1 = 'DISTINCT' and u2 in ('IS', 'NOT') then 'IS DISTINCT FROM'
  when up = 'ON' and u1 = 'DISTINCT' then 'DISTINCT ON'
  when up = 'UPDATE' and u1 is not null and u1 not in (')', ';', 'EXPLAIN')
   and not coalesce(u1 in ('ANALYZE', 'VERBOSE', 'EXTENDED') and u2 in ('EXPLAIN', 'ANALYZE'), false) then 'UPDATE OPTION'
  when up = 'TABLE' and (u1 in ('DROP', 'TRUNCATE') or (u1 = 'TEMPORARY' and u2 = 'DROP')) then 'TABLE LIST'
  when up = 'TABLE' and u1 = 'ALTER' then 'TABLE NAME' else up end as kw from tk3),
f1 as (select *, sum(delta) over (partition by sample_id order by pos rows between unbounded preceding and current row) as cum from tk4),
f2 as (select *, cum - case when tok = '(' then 1 else 0 end as depth from f1),
f3 as (select *, case when tok = '(' then depth + 1 else depth end as k from f2),
f4 as (select *, count(case when tok = '(' then 1 end) over (partition by sample_id, k order by pos
  rows between unbounded preceding and current row) as cnt from f3),
f5 as (select *, case when tok = '(' then coalesce(lag(cnt) over (partition by sample_id order by pos), 0) else cnt end as scope from f4),
f6 as (select *, lag(kw, 1) over w as p1, lag(kw, 2) over w as p2,
  {leads}
  from f5 window w as (partition by sample_id order by pos)),
fr0 as (select *,
  last_value(case when list_contains({_lst(V.CLAUSES)}, kw) then kw end ignore nulls) over (partition by sample_id, depth, scope
    order by pos rows between unbounded preceding and current row) as clause,
  coalesce(bool_or(kw in ('SELECT', 'DELETE')) over (partition by sample_id, depth, scope order by pos
    rows between unbounded preceding and 1 preceding), false) as sel_seen,
  coalesce(bool_or(kw in ('DELETE', 'UPDATE', 'MERGE')) over (partition by sample_id, depth, scope order by pos
    rows between unbounded preceding and 1 preceding), false) as mut_seen
  from f6),
fr as materialized (select *, coalesce(is_id and (p1 in ('INTO', 'UPDATE', 'TRUNCATE', 'TABLE LIST', 'TABLE NAME')
    or coalesce(p1 = 'EXISTS' and p2 = 'IF' and clause in ('TABLE LIST', 'TABLE NAME'), false)
    or (p1 in ('FROM', 'JOIN') and (sel_seen or mut_seen)) or (p1 = 'USING' and mut_seen)
    or coalesce(p1 = ',' and clause in ('FROM', 'JOIN', 'ON', 'USING', 'UPDATE', 'TABLE LIST')
       and (sel_seen or mut_seen or clause = 'TABLE LIST'), false))
   and not (coalesce(case when n1 = '.' and n2_id then n3 else n1 end = '(', false) and p1 <> 'INTO'), false) as is_tref from fr0),
syn as (select sample_id, arg_min(up, pos) as first, min(cum) as min_cum, arg_max(cum, pos) as final_cum,
  arg_max(up, pos) filter (where tok <> ';') as last,
  min(case when tok in ('''', '"', '`') then pos end) as quote_pos,
  min(case when kw = 'SELECT' and n1_up = 'FROM' then pos end) as sf_pos
  from fr group by sample_id),
synp as (select sample_id, case when not list_contains({_lst(V.VERBS)}, first) then concat('unknown statement start ', first)
  when min_cum < 0 or final_cum <> 0 then 'unbalanced parentheses'
  when quote_pos is not null then 'unterminated quoted text'
  when sf_pos is not null then 'empty SELECT list'
  when list_contains({_lst(V.DANGLING)}, last) then concat('statement ends with ', last) end as problem from syn),
tr as materialized (select sample_id, db_id, pos,
  case when n1 = '.' and n2_id then n2_name else name end as table_name,
  case when (case when n1 = '.' and n2_id then n3_up else n1_up end) = 'AS'
       then (case when (case when n1 = '.' and n2_id then n4_id else n2_id end)
                  then (case when n1 = '.' and n2_id then n4_name else n2_name end) end)
       when (case when n1 = '.' and n2_id then n3_id else n1_id end)
       then (case when n1 = '.' and n2_id then n3_name else n1_name end) end as alias
  from fr where is_tref),
bn as materialized (select distinct sample_id, name as bound from fr where is_id and (
  (n1_up = 'AS' and n2 = '(' and (p1 in ('WITH', 'RECURSIVE') or (p1 = ',' and depth = 0 and not sel_seen)))
  or (clause in ('FROM', 'JOIN', 'USING', 'UPDATE') and (p1 = ')' or (p1 = 'AS' and p2 = ')'))))),
cr as materialized (select fr.sample_id, fr.db_id, fr.pos,
  case when fr.n3 = '.' and (fr.n4_id or fr.n4 = '*') and fr.n2_id then fr.n2_name else fr.name end as qualifier,
  case when fr.n3 = '.' and (fr.n4_id or fr.n4 = '*') and fr.n2_id then (case when fr.n4 = '*' then '*' else fr.n4_name end)
       else (case when fr.n2 = '*' then '*' else fr.n2_name end) end as column_name
  from fr where fr.is_id and fr.n1 = '.' and (fr.n2_id or fr.n2 = '*') and coalesce(fr.n3, '') <> '(' and coalesce(fr.p1, '') <> '.' and not is_tref),
amap as (select sample_id, coalesce(alias, table_name) as qualifier, arg_max(table_name, pos) as resolved from tr group by all),
rs as (select cr.sample_id, cr.db_id, cr.pos, cr.qualifier, coalesce(amap.resolved, cr.qualifier) as table_name, cr.column_name
  from cr left join amap on cr.sample_id = amap.sample_id and cr.qualifier = amap.qualifier),
ct as (select distinct db_id, lower(table_name) as table_name from catalog_columns),
cc as (select distinct db_id, lower(table_name) as table_name, lower(column_name) as column_name from catalog_columns),
te as (select sample_id, 2 as stage, pos, 'missing_table' as kind, concat('Schema错误: 表 ''', table_name, ''' 不存在') as message
  from tr where not exists (select 1 from ct where ct.db_id = tr.db_id and ct.table_name = tr.table_name){not_bound.format(t='tr')}),
rsd as (select * from rs where true{not_bound.format(t='rs')}),
ce as (select sample_id, 3 as stage, pos, 'missing_table' as kind, concat('Schema错误: 表 ''', table_name, ''' 不存在') as message
  from rsd where not exists (select 1 from ct where ct.db_id = rsd.db_id and ct.table_name = rsd.table_name)
  union all
  select sample_id, 3, pos, 'missing_column', concat('Schema错误: 字段 ''', table_name, '.', column_name, ''' 不存在')
  from rsd where exists (select 1 from ct where ct.db_id = rsd.db_id and ct.table_name = rsd.table_name)
   and column_name <> '*'
   and not exists (select 1 from cc where cc.db_id = rsd.db_id and cc.table_name = rsd.table_name and cc.column_name = rsd.column_name)),
errs as (
  select sample_id, 0 as stage, 0 as pos, 'blank' as kind, 'empty SQL' as message from d1 where {blank('output')}
  union all select sample_id, 1, 0, 'syntax', '语法错误: no SQL statement' from base where sample_id not in (select sample_id from fr)
  union all select sample_id, 1, 0, 'syntax', concat('语法错误: ', problem) from synp where problem is not null
  union all select * from te union all select * from ce),
first_err as (select * from (select *, row_number() over (partition by sample_id order by stage, pos) as rn from errs) where rn = 1),
verdict as (select d1.*, e.kind is null as valid, e.kind as error_kind, e.message as error
  from d1 left join first_err e on d1.sample_id = e.sample_id)
{final}"""


def _frame(spark, sf_dir, *fields):
    return V.token_frame(V.sql_tokens(fixtures.samples(spark, sf_dir), fields=fields))


@register("sql_tokens", validation_sql("select sample_id, pos, tok as token from fr"))
def q_sql_tokens(spark, sf_dir):
    tokens = V.sql_tokens(fixtures.samples(spark, sf_dir), neighbours=False)
    return tokens.select("sample_id", "pos", F.col("tok").alias("token"))


@register("check_syntax", validation_sql("select sample_id, concat('语法错误: ', problem) as message from synp where problem is not null"))
def q_check_syntax(spark, sf_dir):
    return V.check_syntax(_frame(spark, sf_dir, "syntax")).select("sample_id", "message")


@register("table_refs", validation_sql("select sample_id, pos, table_name, alias from tr"))
def q_table_refs(spark, sf_dir):
    return V.table_refs(_frame(spark, sf_dir, "tref"))


@register("column_refs", validation_sql("select sample_id, pos, qualifier, column_name from cr"))
def q_column_refs(spark, sf_dir):
    return V.column_refs(_frame(spark, sf_dir, "cref"))


def _summary(spark, sf_dir):
    return persist_once(V.statement_summary(fixtures.samples(spark, sf_dir)), spark, "statements")


@register("resolve_aliases", validation_sql("select sample_id, pos, qualifier, table_name, column_name from rs"))
def q_resolve_aliases(spark, sf_dir):
    return V.resolve_aliases(V.statement_summary(fixtures.samples(spark, sf_dir), carry=False))


def _errors(spark, sf_dir, strict=False):
    return V.missing_references(_summary(spark, sf_dir), fixtures.catalog_columns(spark, sf_dir), strict)


@register("validate_tables", validation_sql("select sample_id, pos, message from te"))
def q_validate_tables(spark, sf_dir):
    return _errors(spark, sf_dir).where("stage = 2").select("sample_id", "pos", "message")


@register("validate_columns", validation_sql("select sample_id, pos, kind, message from ce"))
def q_validate_columns(spark, sf_dir):
    return _errors(spark, sf_dir).where("stage = 3").select("sample_id", "pos", "kind", "message")


def verdicts(spark, sf_dir, strict=False):
    return V.validate_samples(fixtures.samples(spark, sf_dir), fixtures.catalog_columns(spark, sf_dir), strict,
                              summary=_summary(spark, sf_dir))


_BINDING = f""",
b0 as (select *, row_number() over (partition by sample_id order by pos) - 1 as i, coalesce(lag(is_id) over (partition by sample_id order by pos), false) as p1_id,
  count(case when kw in ('SELECT', ';') then 1 end) over (partition by sample_id, k, cnt order by pos rows between unbounded preceding and current row) as block,
  first_value(up) over (partition by sample_id order by pos) as verb from fr),
b1 as (select *, min(i) over (partition by sample_id, k, cnt) as slo, max(i) over (partition by sample_id, k, cnt) as shi,
  min(i) over (partition by sample_id, k, cnt, block) as blo, max(i) over (partition by sample_id, k, cnt, block) as bhi
  from b0 where list_contains({_lst(binding.VERBS)}, verb)),
b2 as materialized (select *, case when block = 0 then slo else blo end as lo, case when block = 0 then shi else bhi end as hi,
  p1_id or coalesce(p1 in ('AS', ')', 'END') or regexp_matches(p1, '^[''0-9]'), false) as alias_place,
  coalesce(is_id and n1_up = 'AS' and n2 = '(' and (p1 in ('WITH', 'RECURSIVE') or (p1 = ',' and depth = 0 and not sel_seen)), false) as is_cte,
  coalesce(is_id and clause in ('FROM', 'JOIN', 'USING', 'UPDATE') and (p1 = ')' or (p1 = 'AS' and p2 = ')')), false) as is_derived from b1),
bb as materialized (select sample_id, i as b_lo, shi as b_hi, coalesce(p1 = 'LATERAL', false) as lat, coalesce(p1 = 'USING', false) as joins from b2 where tok = '('),
bt as materialized (select b2.sample_id, b2.i, slo, lo, hi, tr.table_name, tr.alias from b2 join tr using (sample_id, pos)),
bc as materialized (select sample_id, i, name, i + 2 as opens from b2 where is_cte),
bo as materialized (select sample_id, i, slo, lo, name, alias_place from b2 where is_id and clause = 'SELECT' and tok <> '('
  and (n1 is null or list_contains({_lst(binding.ENDS)}, n1_up))),
bs as materialized (select sample_id, i, slo, lo, case when p1 = '.' then regexp_replace(lower(p2), '^["`]|["`]$', '', 'g') end as qualifier
  from b2 where tok = '*' and clause = 'SELECT' and p1 in ('SELECT', 'DISTINCT', 'ALL', ',', '.')),
bd as materialized (select sample_id, i, slo, lo, hi, name, case when p1 = ')' then i - 2 else i - 3 end as ends from b2 where is_derived),
bu as materialized (select sample_id, db_id, i, pos, slo, lo, name from b2 where is_id and not is_tref and not alias_place and coalesce(p1, '') <> '.'
  and coalesce(n1, '') not in ('.', '(') and not starts_with(coalesce(n1, ''), '''') and not is_cte
  and not (coalesce(p1, '') = '(' and coalesce(n1_up, '') = 'FROM')
  and not list_contains({_lst(tuple(V.VERBS) + tuple(V.CLAUSES) + binding.WORDS + ('IS DISTINCT FROM', 'DISTINCT ON'))}, kw)),
br as materialized (
  select sample_id, i, slo, lo, hi, coalesce(alias, table_name) as relation, table_name, -1 as body from bt
   where not exists (select 1 from bc where bc.sample_id = bt.sample_id and bc.name = bt.table_name)
  union all select bt.sample_id, bt.i, slo, lo, hi, coalesce(alias, table_name), null, c.opens from bt
   join (select sample_id, name, arg_min(opens, i) as opens from bc group by all) c on c.sample_id = bt.sample_id and c.name = bt.table_name
  union all select bd.sample_id, bd.i, slo, lo, hi, name, null, b_lo from bd join bb on bb.sample_id = bd.sample_id and b_hi = ends),
bw as (select * from bb where not lat and (exists (select 1 from bc where bc.sample_id = bb.sample_id and opens = b_lo)
  or exists (select 1 from bd where bd.sample_id = bb.sample_id and ends = b_hi))),
bf as materialized (select bu.sample_id, bu.i, coalesce(max(b_lo), -1) as wall
  from bu left join bw on bw.sample_id = bu.sample_id and b_lo < bu.i and bu.i <= b_hi group by all),
bv as materialized (select u.sample_id, u.db_id, u.i, u.name, r.i as rid, r.lo, r.hi, r.relation, r.table_name, r.body
  from bu u join bf using (sample_id, i) join br r on r.sample_id = u.sample_id and r.lo <= u.i and u.i <= r.hi and r.lo >= wall),
bx as materialized (select bv.*,
   exists (select 1 from bo where body >= 0 and bo.sample_id = bv.sample_id and bo.slo = body and bo.name = bv.name)
   or (body < 0 and exists (select 1 from cc where cc.db_id = bv.db_id and cc.table_name = bv.table_name and cc.column_name = bv.name))
   or exists (select 1 from bs join br x on x.sample_id = bs.sample_id and x.lo = bs.lo and coalesce(bs.qualifier = x.relation, true)
              join cc on cc.table_name = x.table_name
              where bs.sample_id = bv.sample_id and bs.slo = bv.body and cc.db_id = bv.db_id and cc.column_name = bv.name) as offers,
   exists (select 1 from bs join br x on x.sample_id = bs.sample_id and x.lo = bs.lo and x.table_name is null and coalesce(bs.qualifier = x.relation, true)
           where bs.sample_id = bv.sample_id and bs.slo = bv.body) as open,
   exists (select 1 from bu m join bb on bb.sample_id = m.sample_id and joins and b_lo = m.slo
           where m.sample_id = bv.sample_id and m.name = bv.name and m.lo > bv.lo and m.i <= bv.hi) as merged from bv),
bn2 as (select sample_id, i, max(lo) as nearest from bx where offers or open group by all),
by2 as materialized (select bx.sample_id, bx.i, count(*) filter (offers) as n, any_value(relation) filter (offers) as relation,
   bool_or(merged) filter (offers) as merged from bx join bn2 using (sample_id, i) where lo = nearest group by all)
select bu.sample_id, bu.pos, bu.name as column_name,
  case when n = 1 then 'bound' when n > 1 then (case when merged then 'merged' else 'ambiguous' end) when n = 0 then 'unknown'
   when exists (select 1 from bo where bo.sample_id = bu.sample_id and alias_place and bo.lo = bu.lo and bo.name = bu.name) then 'alias'
   else 'unresolved' end as status,
  case when n = 1 then relation end as relation,
  exists (select 1 from tr join cc on cc.table_name = tr.table_name where tr.sample_id = bu.sample_id and cc.db_id = bu.db_id and cc.column_name = bu.name) as anywhere
from bu left join by2 using (sample_id, i)"""


@register("unqualified_refs", validation_sql(_BINDING))
def q_unqualified_refs(spark, sf_dir):
    summary = persist_once(binding.binding_summary(fixtures.samples(spark, sf_dir)), spark, "bindings")
    return binding.unqualified_refs(summary, fixtures.catalog_columns(spark, sf_dir))


@register("validate_samples", validation_sql("select * from verdict"))
def q_validate_samples(spark, sf_dir):
    return verdicts(spark, sf_dir)


@register("validate_samples_strict", validation_sql("select * from verdict", strict=True))
def q_validate_samples_strict(spark, sf_dir):
    return verdicts(spark, sf_dir, strict=True)


@register("validation_counts", validation_sql(
    "select db_id, coalesce(error_kind, 'valid') as outcome, count(*) as n from verdict group by all"))
def q_validation_counts(spark, sf_dir):
    return V.validation_counts(verdicts(spark, sf_dir))
