"""Derived inputs: SQL samples, model texts, plans, results and catalogs.

The test tables hold no SQL, model output or catalog, so these are derived
from them with plain expressions (one row per order, document, customer,
supplier ...), which makes every derived input grow with the data.  The oracle
SQL in ``sqlmill.plans.oracle`` derives the same rows in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import table

NL = "\n"


def _s(c) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


# --- D1: one SQL sample per order --------------------------------------------

def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_id, db_id, topic_id, ord, input, output) — twenty-four SQL shapes."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
              "o_orderpriority")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    ks, cs = _s(k), _s(c)
    case = k % 24
    out = (
        F.when(case == 0, F.concat(F.lit("SELECT COUNT(*) FROM orders WHERE o_custkey = "), cs, F.lit(";")))
        .when(case == 1, F.concat(
            F.lit("SELECT c.c_name, SUM(o.o_totalprice) AS total FROM orders o JOIN customer c "
                  "ON o.o_custkey = c.c_custkey WHERE c.c_custkey = "), cs,
            F.lit(" GROUP BY c.c_name ORDER BY total DESC LIMIT 5;")))
        .when(case == 2, F.concat(F.lit("SELECT o.o_missing FROM orders o WHERE o.o_orderkey = "), ks))
        .when(case == 3, F.lit("SELECT * FROM no_such_table;"))
        .when(case == 4, F.concat(F.lit("select o_orderkey from orders -- by key" + NL + "where o_orderkey = "), ks))
        .when(case == 5, F.concat(
            F.lit("SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT AVG(o_totalprice) "
                  "FROM orders WHERE o_custkey = "), cs, F.lit(")")))
        .when(case == 6, F.concat(F.lit("UPDATE orders SET o_orderstatus = 'F' WHERE o_orderkey = "), ks))
        .when(case == 7, F.lit("   "))
        .when(case == 8, F.concat(F.lit("SELECT MAX(l.l_quantity FROM lineitem l WHERE l.l_orderkey = "), ks))
        .when(case == 9, F.concat(
            F.lit("WITH big AS (SELECT o_custkey FROM orders WHERE o_orderkey > "), ks,
            F.lit(") SELECT COUNT(*) FROM big")))
        .when(case == 10, F.concat(
            F.lit("SELECT /* pick */ n.n_name FROM nation AS n, region AS r WHERE n.n_regionkey = "
                  "r.r_regionkey AND r.r_name = 'it''s "), F.col("o_orderstatus"), F.lit("'")))
        .when(case == 11, F.concat(F.lit("INSERT INTO orders SELECT * FROM orders WHERE o_orderkey = "), ks))
        .when(case == 12, F.concat(F.lit("SELECT o_orderkey FROM orders WHERE o_custkey IS NOT DISTINCT FROM o_totalprice + "), ks))
        .when(case == 13, F.concat(F.lit("INSERT INTO orders (o_orderkey, o_custkey) VALUES ("), ks,
                                   F.lit(", 1) ON DUPLICATE KEY UPDATE o_custkey = 2, o_totalprice = 3")))
        .when(case == 14, F.concat(F.lit("SELECT o.o_orderkey FROM orders o WHERE o.o_custkey = "), cs, F.lit(" FOR UPDATE NOWAIT")))
        .when(case == 15, F.concat(F.lit("SELECT o.o_orderkey, g.value FROM orders o, generate_series(1, 3) g WHERE o.o_orderkey = "), ks))
        .when(case == 16, F.concat(F.lit("UPDATE orders o, customer c SET o.o_custkey = c.c_custkey WHERE o.o_orderkey = "), ks))
        .when(case == 17, F.concat(F.lit("EXPLAIN ANALYZE UPDATE no_orders SET o_custkey = "), ks))
        .when(case == 18, F.concat(F.lit("MERGE INTO orders USING no_source s ON orders.o_orderkey = s.o_orderkey WHEN MATCHED THEN UPDATE SET o_custkey = "), ks))
        .when(case == 19, F.concat(F.lit("DELETE FROM orders USING no_customers c WHERE orders.o_custkey = c.c_custkey AND c.c_custkey = "), ks))
        .when(case == 20, F.concat(F.lit("TRUNCATE TABLE no_table_"), ks))
        .when(case == 21, F.concat(F.lit("DROP TABLE IF EXISTS orders, no_archive_"), ks))
        .when(case == 22, F.concat(F.lit("SELECT o.o_orderkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey, no_list n WHERE o.o_orderkey = "), ks))
        .otherwise(F.concat(F.lit("SELECT o_orderkey, n_name, o_nowhere FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey = o_custkey AND n_nationkey = "), ks, F.lit(")")))
    )
    return o.select(
        k.alias("sample_id"), (c % 20).alias("db_id"), (c % 7).alias("topic_id"), k.alias("ord"),
        F.concat(F.lit("How many orders with priority "), F.col("o_orderpriority"),
                 F.lit(" for customer "), cs, F.lit("?")).alias("input"),
        out.alias("output"),
    )


def prediction_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, ord, question, prediction, reference) from D1; run = database."""
    s = samples(spark, sf_dir)
    k = F.col("sample_id")
    pred = (F.when(k % 3 == 0, F.lower("output"))
            .when(k % 3 == 1, F.concat(F.lit("  "), F.col("output")))
            .otherwise(F.concat(F.col("output"), F.lit(" AND 1 = 1"))))
    return s.select(F.col("db_id").alias("run_id"), F.col("ord"), F.col("input").alias("question"),
                    pred.alias("prediction"), F.col("output").alias("reference"))


# --- D2: one model response per customer -------------------------------------

def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(db_id, topic_id, response, target): JSON lines mixed with junk."""
    o = table(spark, sf_dir, "orders", "o_custkey")
    g = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    resp = F.concat(
        F.lit("# generated" + NL + '{"input":" q'), _s("o_custkey"),
        F.lit(' ","output":"SELECT '), _s("n"), F.lit(';"}' + NL + NL + "// note" + NL + "not json" + NL
                                                     + '{"input":"only"}' + NL + '{"input":1,"output":"SELECT 1"}'
                                                     + NL + '["input","output"]' + NL
                                                     + '{"input":"b","output":"SELECT 2 "}'))
    return g.select((F.col("o_custkey") % 20).alias("db_id"), F.col("o_custkey").alias("topic_id"),
                    resp.alias("response"), (F.lit(1) + F.col("o_custkey") % 4).alias("target"))


# --- D3: one model text per document -----------------------------------------

def model_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    k = F.col("doc_id")
    ks = _s(k)
    t = F.col("text")
    txt = (
        F.when(k % 6 == 0, F.concat(F.lit("Sure." + NL + "```SQL" + NL + " SELECT "), ks, F.lit(" "), t,
                                    F.lit(" " + NL + "```" + NL + "done")))
        .when(k % 6 == 1, F.concat(t, F.lit(NL + "```mysql" + NL + "SELECT "), ks, F.lit(" "), t, F.lit(NL + "```")))
        .when(k % 6 == 2, F.concat(F.lit("Answer:" + NL + "  select a" + NL + "  from t;" + NL + "because "), t))
        .when(k % 6 == 3, F.concat(F.lit("SELECT a" + NL + "FROM t" + NL), t))
        .when(k % 6 == 4, F.concat(F.lit("```sql" + NL + "SELECT unclosed "), ks, F.lit(NL), t))
        .otherwise(t)
    )
    return d.select(k.alias("doc_id"), txt.alias("model_text"))


# --- D4: topic plans, one plan per supplier ------------------------------------

# fixed values: the seven catalog tables plus two names no catalog has
PLAN_TABLE_NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                    "shipments", "returns"]


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(plan_id, db_id, ord, name, tables, cnt, total) — a model's raw topic list.

    Topic ``ord`` of plan ``p`` names ``(p + ord) % 10`` tables, the k-th being
    ``PLAN_TABLE_NAMES[(p + ord + k) % 9]``.
    """
    li = table(spark, sf_dir, "lineitem", "l_suppkey", "l_linenumber", "l_quantity")
    g = li.groupBy("l_suppkey", "l_linenumber").agg(F.sum("l_quantity").alias("q"))
    names = F.array(*[F.lit(n) for n in PLAN_TABLE_NAMES])
    n = (F.col("l_suppkey") + F.col("l_linenumber")) % 10
    tables = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(8)), lambda k: k < n),
        lambda k: F.element_at(names, ((F.col("l_suppkey") + F.col("l_linenumber") + k) % 9 + 1).cast("int")),
    )
    return g.select(
        F.col("l_suppkey").alias("plan_id"), F.col("l_suppkey").alias("db_id"),
        F.col("l_linenumber").cast("bigint").alias("ord"),
        F.concat(F.lit("topic"), _s("l_linenumber")).alias("name"),
        tables.alias("tables"),
        (F.col("q") % 90).cast("double").alias("cnt"),
        (F.col("l_suppkey") % 60 + 1).alias("total"),
    )


# --- D5: execution results -----------------------------------------------------

def result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, side, row_idx, c1, c2): reference and predicted result rows.

    By ``query_id % 5``: 0 and 4 equal, 1 reordered, 2 changed cell, 3 missing row.
    """
    from ..operators.ordering import TASK_ROWS, spread
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_returnflag", "l_linenumber")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_returnflag")
    li = spread(li, ["l_orderkey"], -(-li.count() // TASK_ROWS))
    r = li.withColumn("rn", F.row_number().over(w))
    q = F.col("l_orderkey")
    ref = r.select(q.alias("query_id"), F.lit("ref").alias("side"), F.col("rn").cast("bigint").alias("row_idx"),
                   _s("l_partkey").alias("c1"), F.col("l_returnflag").alias("c2"))
    pred = r.where(~((q % 5 == 3) & (F.col("rn") == 1))).select(
        q.alias("query_id"), F.lit("pred").alias("side"),
        F.when(q % 5 == 1, 1000 - F.col("rn")).otherwise(F.col("rn")).cast("bigint").alias("row_idx"),
        F.when((q % 5 == 2) & (F.col("rn") == 1), F.lit("x")).otherwise(_s("l_partkey")).alias("c1"),
        F.col("l_returnflag").alias("c2"))
    return ref.unionByName(pred)


def executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, side, exec_ok, error): one row per query and side."""
    o = table(spark, sf_dir, "lineitem", "l_orderkey").distinct()
    q = F.col("l_orderkey")
    ref = o.select(q.alias("query_id"), F.lit("ref").alias("side"), (q % 13 != 0).alias("exec_ok"))
    pred = o.select(q.alias("query_id"), F.lit("pred").alias("side"), (q % 11 != 0).alias("exec_ok"))
    both = ref.unionByName(pred)
    return both.withColumn("error", F.when(~F.col("exec_ok"), F.concat(F.lit("error in query "), _s("query_id"))))


# --- D6: epoch losses, batch timings, run logs --------------------------------

def epoch_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, epoch, loss): a user's events in (ts, event_id) order are one
    run's epochs.  Numbered with the skew-safe ``positions_within``."""
    from ..operators.ordering import positions_within
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "value")
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    ev = ev.withColumn("_us", us)
    p = positions_within(ev, ["user_id"], ["_us", "event_id"], out="_e")
    return p.select(F.col("user_id").alias("run_id"), F.col("_e").cast("int").alias("epoch"),
                    F.col("value").alias("loss"))


def batch_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "value")
    return ev.select(F.col("user_id").alias("run_id"), F.col("event_id").alias("batch_no"),
                     F.lit(8).cast("bigint").alias("n"), F.col("value").alias("seconds"))


def run_log(spark: SparkSession, sf_dir: str, keep=()) -> DataFrame:
    """(run_id, ts, seq, level_name, step, message) from events."""
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    # fixed values: event type -> logging level name
    level = (F.when(F.col("event_type") == "error", F.lit("ERROR"))
             .when(F.col("event_type") == "signup", F.lit("CRITICAL"))
             .when(F.col("event_type") == "purchase", F.lit("WARNING"))
             .when(F.col("event_type") == "click", F.lit("DEBUG"))
             .otherwise(F.lit("INFO")))
    return ev.select(*keep, F.col("user_id").alias("run_id"), F.col("ts"), F.col("event_id").alias("seq"),
                     level.alias("level_name"), (F.col("event_id") % 6 + 1).alias("step"),
                     F.concat(F.col("event_type"), F.lit(" event "), _s("event_id")).alias("message"))


# --- catalog: seven TPC-H-like tables per database, one database per supplier ---

# fixed values: (table, column, data_type, column_type) in ordinal order
CATALOG_SPEC = [
    ("region", "r_regionkey", "int", "int(11)"), ("region", "r_name", "varchar", "varchar(64)"),
    ("nation", "n_nationkey", "int", "int(11)"), ("nation", "n_name", "varchar", "varchar(64)"),
    ("nation", "n_regionkey", "int", "int(11)"),
    ("customer", "c_custkey", "bigint", "bigint(20)"), ("customer", "c_name", "varchar", "varchar(64)"),
    ("customer", "c_nationkey", "int", "int(11)"), ("customer", "c_acctbal", "double", "double"),
    ("customer", "c_mktsegment", "varchar", "varchar(64)"),
    ("supplier", "s_suppkey", "bigint", "bigint(20)"), ("supplier", "s_name", "varchar", "varchar(64)"),
    ("supplier", "s_nationkey", "int", "int(11)"), ("supplier", "s_acctbal", "double", "double"),
    ("part", "p_partkey", "bigint", "bigint(20)"), ("part", "p_name", "varchar", "varchar(64)"),
    ("part", "p_brand", "varchar", "varchar(64)"), ("part", "p_type", "varchar", "varchar(64)"),
    ("part", "p_size", "int", "int(11)"), ("part", "p_retailprice", "double", "double"),
    ("orders", "o_orderkey", "bigint", "bigint(20)"), ("orders", "o_custkey", "bigint", "bigint(20)"),
    ("orders", "o_orderstatus", "varchar", "varchar(64)"), ("orders", "o_totalprice", "double", "double"),
    ("orders", "o_orderdate", "datetime", ""), ("orders", "o_orderpriority", "varchar", "varchar(64)"),
    ("lineitem", "l_orderkey", "bigint", "bigint(20)"), ("lineitem", "l_partkey", "bigint", "bigint(20)"),
    ("lineitem", "l_suppkey", "bigint", "bigint(20)"), ("lineitem", "l_linenumber", "int", "int(11)"),
    ("lineitem", "l_quantity", "double", "double"), ("lineitem", "l_extendedprice", "double", "double"),
    ("lineitem", "l_discount", "double", "double"), ("lineitem", "l_tax", "double", "double"),
    ("lineitem", "l_returnflag", "varchar", "varchar(64)"), ("lineitem", "l_linestatus", "varchar", "varchar(64)"),
    ("lineitem", "l_shipdate", "datetime", ""),
]
# fixed values: primary key (first key column) per table
CATALOG_PK = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey",
              "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
              "lineitem": "l_orderkey"}
# fixed values: foreign keys (table, column, referenced table, referenced column)
CATALOG_FK = [("nation", "n_regionkey", "region", "r_regionkey"),
              ("customer", "c_nationkey", "nation", "n_nationkey"),
              ("orders", "o_custkey", "customer", "c_custkey"),
              ("lineitem", "l_orderkey", "orders", "o_orderkey"),
              ("lineitem", "l_partkey", "part", "p_partkey"),
              ("lineitem", "l_suppkey", "supplier", "s_suppkey")]


def _catalog_rows():
    pos = {}
    rows = []
    fk_cols = {(t, c) for t, c, _, _ in CATALOG_FK}
    for t, c, dt, ct in CATALOG_SPEC:
        pos[t] = pos.get(t, 0) + 1
        p = pos[t]
        key = "PRI" if CATALOG_PK[t] == c else ("MUL" if (t, c) in fk_cols else "")
        nullable = "NO" if c.endswith("key") else "YES"
        comment = "" if p % 2 == 1 else f"the {c.split('_', 1)[1]} field"
        rows.append((t, c, dt, ct, nullable, key, comment, p))
    return rows


def _databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier", "s_suppkey").select(F.col("s_suppkey").alias("db_id"))


def _explode_literal(db: DataFrame, rows, names) -> DataFrame:
    """Attach a fixed row list to every database with a generator (no join)."""
    arr = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows])
    return db.select("db_id", F.inline(arr))


def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """information_schema.COLUMNS-like rows; table ``part`` is absent where db_id % 5 = 4."""
    names = ["table_name", "column_name", "data_type", "column_type", "is_nullable",
             "column_key", "column_comment", "ordinal_position"]
    df = _explode_literal(_databases(spark, sf_dir), _catalog_rows(), names)
    return df.where(~((F.col("table_name") == "part") & (F.col("db_id") % 5 == 4)))


def catalog_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (catalog_columns(spark, sf_dir).where(F.col("column_key") == "PRI")
            .select("db_id", "table_name", "column_name", "ordinal_position"))


def catalog_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(db_id, table_name, column_name, ref_table, ref_column); both tables must exist."""
    db = _databases(spark, sf_dir)
    fk = _explode_literal(db, CATALOG_FK, ["table_name", "column_name", "ref_table", "ref_column"])
    has_part = F.col("db_id") % 5 != 4
    return fk.where(has_part | ((F.col("table_name") != "part") & (F.col("ref_table") != "part")))


def info_schema(spark: SparkSession, sf_dir: str):
    """Postgres-style constraint tables: (table_constraints, key_column_usage,
    constraint_column_usage), keyed by schema ``db<db_id>``."""
    pk = catalog_pk(spark, sf_dir)
    fk = catalog_fk(spark, sf_dir)
    schema = F.concat(F.lit("db"), _s("db_id")).alias("constraint_schema")
    pk_name = F.concat(F.lit("pk_"), F.col("table_name")).alias("constraint_name")
    fk_name = F.concat(F.lit("fk_"), F.col("table_name"), F.lit("_"), F.col("column_name")).alias("constraint_name")
    tc = (pk.select(schema, pk_name, "table_name", F.lit("PRIMARY KEY").alias("constraint_type"))
          .unionByName(fk.select(schema, fk_name, "table_name", F.lit("FOREIGN KEY").alias("constraint_type"))))
    kcu = (pk.select(schema, pk_name, "table_name", "column_name", F.lit(1).alias("ordinal_position"))
           .unionByName(fk.select(schema, fk_name, "table_name", "column_name",
                                  F.lit(1).alias("ordinal_position"))))
    ccu = (pk.select(schema, pk_name, "table_name", "column_name")
           .unionByName(fk.select(schema, fk_name, F.col("ref_table").alias("table_name"),
                                  F.col("ref_column").alias("column_name"))))
    return tc, kcu, ccu


# --- plan responses: D4 topics serialised as model output ---------------------

def _topic_json() -> Column:
    tables = F.array_join(F.transform("tables", lambda t: F.concat(F.lit('"'), t, F.lit('"'))), ",")
    return F.concat(F.lit('{"name":"'), F.col("name"), F.lit('","tables":['), tables,
                    F.lit('],"reason":"r'), _s("ord"), F.lit('","count":'), _s("cnt"),
                    F.lit(',"dialect":"mysql"}'))


def plan_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(plan_id, db_id, total, response): one model answer per plan, in five wrappings
    by ``plan_id % 5``: bare object, ```json fence, object inside prose, bare list in a
    plain fence, and broken (truncated fence when % 10 = 4, no ``topics`` when % 10 = 9)."""
    t = topics(spark, sf_dir).select("plan_id", "db_id", "total", "ord", _topic_json().alias("o"))
    g = t.groupBy("plan_id", "db_id", "total").agg(F.sort_array(F.collect_list(F.struct("ord", "o"))).alias("l"))
    body = F.array_join(F.transform("l", lambda x: x["o"]), ",")
    obj = F.concat(F.lit('{"topics":['), body, F.lit("]}"))
    p = F.col("plan_id")
    resp = (F.when(p % 5 == 0, obj)
            .when(p % 5 == 1, F.concat(F.lit("Plan below." + NL + "```json" + NL), obj, F.lit(NL + "```")))
            .when(p % 5 == 2, F.concat(F.lit("Here you go: "), obj, F.lit(" hope it helps")))
            .when(p % 5 == 3, F.concat(F.lit("```" + NL + "["), body, F.lit("]" + NL + "```")))
            .when(p % 10 == 4, F.concat(F.lit("```json" + NL + '{"topics":['), body, F.lit(NL + "```")))
            .otherwise(F.concat(F.lit('{"plan":['), body, F.lit("]}"))))
    return g.select("plan_id", "db_id", "total", resp.alias("response"))


# --- corpora in both instruction formats ----------------------------------------

def alpaca_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, instruction, input, output): two instruction rows per document,
    ``input`` being its whole text in one (doc_id doubled) and empty in the other
    (doubled plus one)."""
    d = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "n_chars")
    d = d.select("lang", "n_chars", F.inline(F.array(
        F.struct((2 * F.col("doc_id")).alias("doc_id"), F.col("text").alias("input")),
        F.struct((2 * F.col("doc_id") + 1).alias("doc_id"), F.lit("").alias("input")))))
    return d.select(
        "doc_id", "lang",
        F.concat(F.lit("Write SQL for document "), _s("doc_id"), F.lit(" ("), F.col("lang"), F.lit(")  ")).alias("instruction"),
        "input",
        F.concat(F.lit(" SELECT "), _s("n_chars"), F.lit(" FROM documents;" + NL)).alias("output"))


def mixed_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset_id, ord, instruction, input, output, conversations): alpaca rows
    (one dataset per language) and ShareGPT rows (dataset 'chats')."""
    from ..operators.parse import nest_conversations
    a = alpaca_rows(spark, sf_dir)
    a = a.select(F.concat(F.lit("docs-"), F.col("lang")).alias("dataset_id"), F.col("doc_id").alias("ord"),
                 "instruction", "input", "output",
                 F.lit(None).cast("array<struct<role:string,content:string>>").alias("conversations"))
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    c = nest_conversations(turns).select(
        F.lit("chats").alias("dataset_id"), F.col("conv_id").alias("ord"),
        F.lit(None).cast("string").alias("instruction"), F.lit(None).cast("string").alias("input"),
        F.lit(None).cast("string").alias("output"), "conversations")
    return a.unionByName(c)


# --- uploads and caption requests, from web pages --------------------------------

def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, name, mime, content): one upload per page; the name is the last
    URL path segment plus '.png' ('.txt', text/plain, when page_id % 10 = 9)."""
    p = table(spark, sf_dir, "pages", "page_id", "url", "html")
    txt = F.col("page_id") % 10 == 9
    name = F.concat(F.regexp_extract("url", r"/([^/?#]*)(?:[?#].*)?$", 1),
                    F.when(txt, F.lit(".txt")).otherwise(F.lit(".png")))
    return p.select("page_id", name.alias("name"),
                    F.when(txt, F.lit("text/plain")).otherwise(F.lit("image/png")).alias("mime"),
                    F.encode("html", "UTF-8").alias("content"))


def stored_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, original_name, saved_name, size) for image uploads; the unique id
    is md5(page_id) so that tests are repeatable."""
    from .files import upload_manifest
    u = uploads(spark, sf_dir).where(F.col("mime").startswith("image/"))
    return upload_manifest(u, F.md5(_s("page_id")), keep=("page_id",))


def caption_requests(spark: SparkSession, sf_dir: str):
    """(requested, mapping): every stored image name plus a missing name for
    page_id % 17 = 0; the client's name mapping covers page_id % 3 <> 0."""
    st = stored_uploads(spark, sf_dir)
    req = st.select(F.col("saved_name").alias("file")).unionByName(
        st.where(F.col("page_id") % 17 == 0).select(
            F.concat(F.lit("missing-"), _s("page_id"), F.lit(".png")).alias("file")))
    mapping = st.where(F.col("page_id") % 3 != 0).select("saved_name", "original_name")
    return req, mapping
