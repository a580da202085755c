"""Queries for catalog assembly, table cards and DDL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog as cat
from ..sources import fixtures
from .oracle_base import CATALOG, D4
from .registry import register

BLACKLIST = ("lineitem",)


def assembled(spark, sf_dir, blacklist=()):
    return cat.assemble_catalog(fixtures.catalog_columns(spark, sf_dir), fixtures.catalog_pk(spark, sf_dir),
                                fixtures.catalog_fk(spark, sf_dir), blacklist=blacklist)


def _names(col="columns"):
    return F.array_join(F.transform(col, lambda c: c["name"]), ",")


def _fk_text(col="foreign_keys"):
    return F.array_join(F.transform(F.map_entries(col), lambda e: F.concat(e["key"], F.lit("->"), e["value"])), ";")


# oracle: the same catalog, flat rows aggregated per table
BASE = f"""with {CATALOG},
pks as (select db_id, table_name, list(column_name order by ordinal_position) as pkl from catalog_pk group by all),
fk1 as (select db_id, table_name, column_name, max(concat_ws('.', ref_table, ref_column)) as ref from catalog_fk group by all),
fks as (select db_id, table_name, count(*) as nfk,
  string_agg(concat(column_name, '->', ref), ';' order by column_name) as fk_text,
  string_agg(concat('  - ', column_name, ' -> ', ref), chr(10) order by column_name) as card_fk,
  string_agg(concat('--   ', column_name, ' -> ', ref), chr(10) order by column_name) as ddl_fk
  from fk1 group by all),
cc as (select c.*, coalesce(p.pkl, []) as pkl from catalog_columns c left join pks p using (db_id, table_name)),
cd as (select *, coalesce(nullif(column_type, ''), data_type) as ctype,
  concat_ws('，', case when list_contains(pkl, column_name) then '主键' end,
   case when coalesce(column_comment, '') <> '' then column_comment end,
   case when is_nullable <> 'YES' and not list_contains(pkl, column_name) then '必填' end) as d0 from cc),
cd2 as (select *, upper(ctype) as type, case when d0 = '' then ctype else d0 end as "desc" from cd),
tbl as (select db_id, table_name, count(*) as n_columns, string_agg(column_name, ',' order by ordinal_position) as column_names,
  string_agg(concat('  - ', column_name, ' (', type, '): ', "desc"), chr(10) order by ordinal_position) as card_cols,
  string_agg(concat('  ', column_name, ' ', coalesce(column_type, ''),
    case when is_nullable <> 'YES' then ' NOT NULL' else '' end,
    case when coalesce(column_comment, '') <> '' then concat(' COMMENT ''', column_comment, '''') else '' end),
    concat(',', chr(10)) order by ordinal_position) as coldefs,
  any_value(pkl) as pkl from cd2 group by all),
cat as (select t.*, coalesce(f.nfk, 0) as nfk, coalesce(f.fk_text, '') as fk_text, f.card_fk, f.ddl_fk,
  concat(t.table_name, '表', '，包含', cast(t.n_columns as varchar), '个字段',
    case when coalesce(f.nfk, 0) > 0 then '，有外键关联' else '' end, '。') as summary
  from tbl t left join fks f using (db_id, table_name)),
blocks as (select *, concat(chr(10), '### 表: ', table_name, chr(10), '说明: ', summary, chr(10), '字段:', chr(10), card_cols,
   case when nfk > 0 then concat(chr(10), '外键关系:', chr(10), card_fk) else '' end) as block,
  concat(chr(10), 'CREATE TABLE ', table_name, ' (', chr(10), coldefs,
   case when len(pkl) > 0 then concat(',', chr(10), '  PRIMARY KEY (', array_to_string(pkl, ', '), ')') else '' end,
   chr(10), ');', case when nfk > 0 then concat(chr(10), '-- 外键关系:', chr(10), ddl_fk) else '' end) as ddl
  from cat)"""


@register("columns_by_table", BASE + " select db_id, table_name, n_columns, column_names from cat")
def q_columns_by_table(spark, sf_dir):
    c = cat.columns_by_table(fixtures.catalog_columns(spark, sf_dir))
    return c.select("db_id", "table_name", F.size("columns").cast("bigint").alias("n_columns"), _names().alias("column_names"))


@register("pk_by_table", BASE + " select db_id, table_name, array_to_string(pkl, ',') as primary_keys from pks")
def q_pk_by_table(spark, sf_dir):
    p = cat.pk_by_table(fixtures.catalog_pk(spark, sf_dir))
    return p.select("db_id", "table_name", F.array_join("primary_keys", ",").alias("primary_keys"))


@register("fk_map", BASE + " select db_id, table_name, fk_text as foreign_keys from fks")
def q_fk_map(spark, sf_dir):
    m = cat.fk_map(fixtures.catalog_fk(spark, sf_dir))
    return m.select("db_id", "table_name", _fk_text().alias("foreign_keys"))


@register("catalog_assemble", BASE + """ select db_id, table_name, n_columns, column_names,
 array_to_string(pkl, ',') as primary_keys, fk_text as foreign_keys from cat""")
def q_catalog_assemble(spark, sf_dir):
    a = assembled(spark, sf_dir)
    return a.select("db_id", "table_name", F.size("columns").cast("bigint").alias("n_columns"), _names().alias("column_names"),
                    F.array_join("primary_keys", ",").alias("primary_keys"), _fk_text().alias("foreign_keys"))


@register("catalog_blacklist", BASE + " select db_id, table_name from cat where table_name not in ('lineitem')")
def q_catalog_blacklist(spark, sf_dir):
    return assembled(spark, sf_dir, blacklist=BLACKLIST).select("db_id", "table_name")


@register("table_count", BASE + " select db_id, count(distinct table_name) as n_tables from catalog_columns group by db_id")
def q_table_count(spark, sf_dir):
    return cat.table_count(fixtures.catalog_columns(spark, sf_dir))



@register("catalog_pk_join", BASE + """ select concat('db', cast(db_id as varchar)) as constraint_schema, table_name,
 column_name, 1 as ordinal_position from catalog_pk""")
def q_catalog_pk_join(spark, sf_dir):
    tc, kcu, _ = fixtures.info_schema(spark, sf_dir)
    return cat.catalog_pk_join(tc, kcu)


@register("catalog_fk_join", BASE + """ select concat('db', cast(db_id as varchar)) as constraint_schema, table_name,
 column_name, ref_table, ref_column from catalog_fk""")
def q_catalog_fk_join(spark, sf_dir):
    tc, kcu, ccu = fixtures.info_schema(spark, sf_dir)
    return cat.catalog_fk_join(tc, kcu, ccu)


@register("table_summary", BASE + " select db_id, table_name, summary from cat")
def q_table_summary(spark, sf_dir):
    return cat.table_cards(assembled(spark, sf_dir)).select("db_id", "table_name", "summary")


@register("column_desc", BASE + ' select db_id, table_name, column_name, ordinal_position, type, "desc" from cd2')
def q_column_desc(spark, sf_dir):
    c = cat.table_cards(assembled(spark, sf_dir))
    e = c.select("db_id", "table_name", F.posexplode("columns").alias("i", "c"))
    return e.select("db_id", "table_name", F.col("c.name").alias("column_name"),
                    (F.col("i") + 1).alias("ordinal_position"), F.col("c.type").alias("type"),
                    F.col("c.desc").alias("desc"))


@register("cards_text", BASE + " select db_id, string_agg(block, chr(10) order by table_name) as cards_text from blocks group by db_id")
def q_cards_text(spark, sf_dir):
    return cat.cards_text(cat.table_cards(assembled(spark, sf_dir)))


@register("table_ddl", BASE + " select db_id, table_name, ddl from blocks")
def q_table_ddl(spark, sf_dir):
    return cat.table_ddl(assembled(spark, sf_dir))


@register("topic_ddl", BASE + f""", {D4},
t as (select plan_id, ord, db_id, unnest(tables) as table_name, generate_subscripts(tables, 1) as i from d4),
g as (select plan_id, ord, string_agg(b.ddl, chr(10) order by t.i) as ddl from t join blocks b using (db_id, table_name) group by all)
select d4.plan_id, d4.ord, coalesce(g.ddl, '') as ddl from d4 left join g using (plan_id, ord)""")
def q_topic_ddl(spark, sf_dir):
    ddl = cat.table_ddl(assembled(spark, sf_dir))
    return cat.topic_ddl(fixtures.topics(spark, sf_dir), ddl)


CARDS_JSON_SQL = BASE + """,
cols as (select db_id, table_name, list(struct_pack(name := column_name, type := type, "desc" := "desc")
  order by ordinal_position) as columns from cd2 group by all),
fkm as (select db_id, table_name, map_from_entries(list(struct_pack(k := column_name, v := ref) order by column_name)) as fks
  from fk1 group by all),
card as (select c.db_id, c.table_name, struct_pack(summary := cat.summary, columns := c.columns,
  foreign_keys := coalesce(fkm.fks, map_from_entries([]::struct(k varchar, v varchar)[]))) as card
  from cols c join cat using (db_id, table_name) left join fkm using (db_id, table_name))
select db_id, to_json(map_from_entries(list(struct_pack(k := table_name, v := card) order by table_name)))::varchar as cards_json
from card group by db_id"""


@register("cards_json", CARDS_JSON_SQL)
def q_cards_json(spark, sf_dir):
    return cat.cards_json(cat.table_cards(assembled(spark, sf_dir)))


CATALOG_JSON_SQL = BASE + """,
ccols as (select db_id, table_name, list(struct_pack(name := column_name, type := data_type, column_type := column_type, nullable := is_nullable = 'YES',
   key := column_key, comment := column_comment, position := ordinal_position) order by ordinal_position) as columns from catalog_columns group by all),
cfk as (select db_id, table_name, map_from_entries(list(struct_pack(k := column_name, v := concat(ref_table, '.', ref_column)) order by column_name)) as fks
  from catalog_fk group by all),
centry as (select c.db_id, c.table_name, struct_pack(columns := c.columns, primary_keys := coalesce(pks.pkl, []::varchar[]),
   foreign_keys := coalesce(cfk.fks, map_from_entries([]::struct(k varchar, v varchar)[]))) as entry
  from ccols c left join pks using (db_id, table_name) left join cfk using (db_id, table_name))
select db_id, to_json(map_from_entries(list(struct_pack(k := table_name, v := entry) order by table_name)))::varchar as catalog_json
from centry group by db_id"""


@register("catalog_json", CATALOG_JSON_SQL)
def q_catalog_json(spark, sf_dir):
    return cat.catalog_json(assembled(spark, sf_dir))
