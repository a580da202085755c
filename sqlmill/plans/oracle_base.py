"""DuckDB building blocks for the oracle SQL: the same derivations and text
rules as the Spark side, written once as SQL fragments."""

from __future__ import annotations

from ..functions.text import PY_WHITESPACE, SQL_KEYWORDS, SQL_LEXER_RE2, WS_CLASS, WORD_RE
from ..sources.fixtures import (CATALOG_FK, CATALOG_PK, PLAN_TABLE_NAMES, _catalog_rows)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


WS_LIT = q(PY_WHITESPACE)
WS_RE = q(WS_CLASS)
WORD_LIT = q(WORD_RE)
LEX_LIT = q(SQL_LEXER_RE2)
KW_LIST = "[" + ", ".join(q(k) for k in SQL_KEYWORDS) + "]"


def strip(x: str) -> str:
    return f"trim({x}, {WS_LIT})"


def blank(x: str) -> str:
    return f"coalesce({strip(x)} = '', true)"


def tokens(x: str) -> str:
    return f"list_distinct(regexp_extract_all(lower({x}), {WORD_LIT}))"


NL = "chr(10)"

D1 = f"""
d1 as (
 select o_orderkey as sample_id, o_custkey % 20 as db_id, o_custkey % 7 as topic_id, o_orderkey as ord,
  concat('How many orders with priority ', o_orderpriority, ' for customer ', cast(o_custkey as varchar), '?') as input,
  case o_orderkey % 24
   when 0 then concat('SELECT COUNT(*) FROM orders WHERE o_custkey = ', cast(o_custkey as varchar), ';')
   when 1 then concat('SELECT c.c_name, SUM(o.o_totalprice) AS total FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE c.c_custkey = ', cast(o_custkey as varchar), ' GROUP BY c.c_name ORDER BY total DESC LIMIT 5;')
   when 2 then concat('SELECT o.o_missing FROM orders o WHERE o.o_orderkey = ', cast(o_orderkey as varchar))
   when 3 then 'SELECT * FROM no_such_table;'
   when 4 then concat('select o_orderkey from orders -- by key', chr(10), 'where o_orderkey = ', cast(o_orderkey as varchar))
   when 5 then concat('SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT AVG(o_totalprice) FROM orders WHERE o_custkey = ', cast(o_custkey as varchar), ')')
   when 6 then concat('UPDATE orders SET o_orderstatus = ''F'' WHERE o_orderkey = ', cast(o_orderkey as varchar))
   when 7 then '   '
   when 8 then concat('SELECT MAX(l.l_quantity FROM lineitem l WHERE l.l_orderkey = ', cast(o_orderkey as varchar))
   when 9 then concat('WITH big AS (SELECT o_custkey FROM orders WHERE o_orderkey > ', cast(o_orderkey as varchar), ') SELECT COUNT(*) FROM big')
   when 10 then concat('SELECT /* pick */ n.n_name FROM nation AS n, region AS r WHERE n.n_regionkey = r.r_regionkey AND r.r_name = ''it''''s ', o_orderstatus, '''')
   when 11 then concat('INSERT INTO orders SELECT * FROM orders WHERE o_orderkey = ', cast(o_orderkey as varchar))
   when 12 then concat('SELECT o_orderkey FROM orders WHERE o_custkey IS NOT DISTINCT FROM o_totalprice + ', cast(o_orderkey as varchar))
   when 13 then concat('INSERT INTO orders (o_orderkey, o_custkey) VALUES (', cast(o_orderkey as varchar), ', 1) ON DUPLICATE KEY UPDATE o_custkey = 2, o_totalprice = 3')
   when 14 then concat('SELECT o.o_orderkey FROM orders o WHERE o.o_custkey = ', cast(o_custkey as varchar), ' FOR UPDATE NOWAIT')
   when 15 then concat('SELECT o.o_orderkey, g.value FROM orders o, generate_series(1, 3) g WHERE o.o_orderkey = ', cast(o_orderkey as varchar))
   when 16 then concat('UPDATE orders o, customer c SET o.o_custkey = c.c_custkey WHERE o.o_orderkey = ', cast(o_orderkey as varchar))
   when 17 then concat('EXPLAIN ANALYZE UPDATE no_orders SET o_custkey = ', cast(o_orderkey as varchar))
   when 18 then concat('MERGE INTO orders USING no_source s ON orders.o_orderkey = s.o_orderkey WHEN MATCHED THEN UPDATE SET o_custkey = ', cast(o_orderkey as varchar))
   when 19 then concat('DELETE FROM orders USING no_customers c WHERE orders.o_custkey = c.c_custkey AND c.c_custkey = ', cast(o_orderkey as varchar))
   when 20 then concat('TRUNCATE TABLE no_table_', cast(o_orderkey as varchar))
   when 21 then concat('DROP TABLE IF EXISTS orders, no_archive_', cast(o_orderkey as varchar))
   when 22 then concat('SELECT o.o_orderkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey, no_list n WHERE o.o_orderkey = ', cast(o_orderkey as varchar))
   else concat('SELECT o_orderkey, n_name, o_nowhere FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey = o_custkey AND n_nationkey = ', cast(o_orderkey as varchar), ')') end as output
 from orders)"""

PAIRS = D1 + """,
pairs as (
 select db_id as run_id, ord, input as question,
  case when sample_id % 3 = 0 then lower(output) when sample_id % 3 = 1 then concat('  ', output)
       else concat(output, ' AND 1 = 1') end as prediction,
  output as reference
 from d1)"""

D2 = """
d2 as (
 select o_custkey % 20 as db_id, o_custkey as topic_id,
  concat('# generated', chr(10), '{"input":" q', cast(o_custkey as varchar), ' ","output":"SELECT ', cast(count(*) as varchar), ';"}', chr(10), chr(10),
   '// note', chr(10), 'not json', chr(10), '{"input":"only"}', chr(10), '{"input":1,"output":"SELECT 1"}', chr(10),
   '["input","output"]', chr(10), '{"input":"b","output":"SELECT 2 "}') as response,
  1 + o_custkey % 4 as target
 from orders group by o_custkey)"""

D3 = """
d3 as (
 select doc_id, case doc_id % 6
  when 0 then concat('Sure.', chr(10), '```SQL', chr(10), ' SELECT ', cast(doc_id as varchar), ' ', text, ' ', chr(10), '```', chr(10), 'done')
  when 1 then concat(text, chr(10), '```mysql', chr(10), 'SELECT ', cast(doc_id as varchar), ' ', text, chr(10), '```')
  when 2 then concat('Answer:', chr(10), '  select a', chr(10), '  from t;', chr(10), 'because ', text)
  when 3 then concat('SELECT a', chr(10), 'FROM t', chr(10), text)
  when 4 then concat('```sql', chr(10), 'SELECT unclosed ', cast(doc_id as varchar), chr(10), text)
  else text end as model_text
 from documents)"""

_NAMES = "[" + ", ".join(q(n) for n in PLAN_TABLE_NAMES) + "]"
D4 = f"""
d4 as (
 select l_suppkey as plan_id, l_suppkey as db_id, cast(l_linenumber as bigint) as ord,
  concat('topic', cast(l_linenumber as varchar)) as name,
  list_transform(list_filter(range(0, 9), lambda k: k < (l_suppkey + l_linenumber) % 10),
                 lambda k: {_NAMES}[((l_suppkey + l_linenumber + k) % 9 + 1)::int]) as tables,
  cast(sum(l_quantity) % 90 as double) as cnt, (l_suppkey % 60) + 1 as total
 from lineitem group by l_suppkey, l_linenumber)"""

D5 = """
r5 as (select l_orderkey, l_partkey, l_returnflag, row_number() over (partition by l_orderkey
  order by l_linenumber, l_partkey, l_returnflag) as rn from lineitem),
d5 as (
 select l_orderkey as query_id, 'ref' as side, rn as row_idx, cast(l_partkey as varchar) as c1, l_returnflag as c2 from r5
 union all
 select l_orderkey, 'pred', case when l_orderkey % 5 = 1 then 1000 - rn else rn end,
  case when l_orderkey % 5 = 2 and rn = 1 then 'x' else cast(l_partkey as varchar) end, l_returnflag
 from r5 where not (l_orderkey % 5 = 3 and rn = 1)),
q5 as (select distinct l_orderkey as query_id from lineitem),
x5 as (
 select query_id, 'ref' as side, query_id % 13 <> 0 as exec_ok from q5
 union all select query_id, 'pred', query_id % 11 <> 0 from q5),
e5 as (select *, case when not exec_ok then concat('error in query ', cast(query_id as varchar)) end as error from x5)"""

D6 = """
d6 as (select user_id as run_id, cast(row_number() over (partition by user_id order by ts, event_id) as int) as epoch,
  value as loss from events)"""


def _values(rows) -> str:
    out = []
    for r in rows:
        out.append("(" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in r) + ")")
    return ", ".join(out)


CATALOG = f"""
cat_spec(table_name, column_name, data_type, column_type, is_nullable, column_key, column_comment, ordinal_position) as (
 values {_values(_catalog_rows())}),
catalog_columns as (
 select s_suppkey as db_id, c.* from supplier, cat_spec c
 where not (c.table_name = 'part' and s_suppkey % 5 = 4)),
catalog_pk as (
 select db_id, table_name, column_name, ordinal_position from catalog_columns where column_key = 'PRI'),
fk_spec(table_name, column_name, ref_table, ref_column) as (values {_values(CATALOG_FK)}),
catalog_fk as (
 select s_suppkey as db_id, f.* from supplier, fk_spec f
 where s_suppkey % 5 <> 4 or (f.table_name <> 'part' and f.ref_table <> 'part'))"""

assert set(CATALOG_PK) == {t for t, *_ in _catalog_rows()}
