"""Database catalogs: scans, primary/foreign keys, assembly, table cards, DDL.

Every table is keyed by ``db_id``, so one plan handles any number of
databases.  Groups here are per table (its columns) or per database (its
tables) — bounded by schema size, never by data volume — which is what makes
``collect_list`` safe.  Catalog frames are small, but no broadcast is forced:
Catalyst picks broadcast from size estimates and AQE from runtime sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: card and DDL wording -------------------------------------
TABLE_SUFFIX = "表"                 # "<table>表"
COLUMN_COUNT = "，包含{n}个字段"     # ", with n columns"
HAS_FK = "，有外键关联"              # ", has foreign keys"
SENTENCE_END = "。"
PK_MARK = "主键"                    # primary key
REQUIRED_MARK = "必填"              # required (NOT NULL, not a key)
DESC_SEP = "，"
CARD_HEADER = "\n### 表: "
CARD_SUMMARY = "说明: "
CARD_COLUMNS = "字段:"
CARD_FKS = "外键关系:"
DDL_FK_HEADER = "-- 外键关系:"
# --- end of fixed values ----------------------------------------------------

COLUMN_STRUCT = "struct<name:string,type:string,column_type:string,nullable:boolean,key:string,comment:string,position:int>"

# information_schema queries (per database) for the JDBC scan
_MYSQL_COLUMNS = """(SELECT c.TABLE_SCHEMA AS db_name, c.TABLE_NAME AS table_name, c.COLUMN_NAME AS column_name,
 c.DATA_TYPE AS data_type, c.COLUMN_TYPE AS column_type, c.IS_NULLABLE AS is_nullable, c.COLUMN_KEY AS column_key,
 c.COLUMN_COMMENT AS column_comment, c.ORDINAL_POSITION AS ordinal_position
 FROM information_schema.COLUMNS c) q"""
_MYSQL_PK = """(SELECT TABLE_SCHEMA AS db_name, TABLE_NAME AS table_name, COLUMN_NAME AS column_name,
 ORDINAL_POSITION AS ordinal_position FROM information_schema.KEY_COLUMN_USAGE WHERE CONSTRAINT_NAME = 'PRIMARY') q"""
_MYSQL_FK = """(SELECT TABLE_SCHEMA AS db_name, TABLE_NAME AS table_name, COLUMN_NAME AS column_name,
 REFERENCED_TABLE_NAME AS ref_table, REFERENCED_COLUMN_NAME AS ref_column
 FROM information_schema.KEY_COLUMN_USAGE WHERE REFERENCED_TABLE_NAME IS NOT NULL) q"""


_PG_COLUMNS = """(SELECT c.table_schema AS db_name, c.table_name AS table_name, c.column_name AS column_name,
 c.data_type AS data_type, c.udt_name AS column_type, c.is_nullable AS is_nullable, '' AS column_key,
 '' AS column_comment, c.ordinal_position AS ordinal_position FROM information_schema.columns c) q"""
_PG_TC = "(SELECT constraint_schema, constraint_name, table_name, constraint_type FROM information_schema.table_constraints) q"
_PG_KCU = """(SELECT constraint_schema, constraint_name, table_name, column_name, ordinal_position
 FROM information_schema.key_column_usage) q"""
_PG_CCU = """(SELECT constraint_schema, constraint_name, table_name, column_name
 FROM information_schema.constraint_column_usage) q"""


def _literal(name: str) -> str:
    """A database name as SQL text, quotes and (for MySQL) backslashes escaped."""
    return "'" + name.replace("\\", "\\\\").replace("'", "''") + "'"


def read_catalog_jdbc(spark: SparkSession, url: str, databases: list[str], properties: dict,
                      db_type: str = "mysql"):
    """One JDBC partition per schema (``predicates``), so many databases
    are read in parallel and the schema filter runs in the source.  Returns
    (columns, pk, fk) keyed by ``db_name``.  Postgres keys come from the
    constraint tables through J2/J3.  Other database types are not supported
    (the reference declares SQL Server but raises)."""
    if db_type == "mysql":
        preds = [f"db_name = {_literal(d)}" for d in databases]
        cols = spark.read.jdbc(url, _MYSQL_COLUMNS, predicates=preds, properties=properties)
        pk = spark.read.jdbc(url, _MYSQL_PK, predicates=preds, properties=properties)
        fk = spark.read.jdbc(url, _MYSQL_FK, predicates=preds, properties=properties)
        return cols, pk, fk
    if db_type == "postgres":
        preds = [f"db_name = {_literal(d)}" for d in databases]
        cpreds = [f"constraint_schema = {_literal(d)}" for d in databases]
        cols = spark.read.jdbc(url, _PG_COLUMNS, predicates=preds, properties=properties)
        tc = spark.read.jdbc(url, _PG_TC, predicates=cpreds, properties=properties)
        kcu = spark.read.jdbc(url, _PG_KCU, predicates=cpreds, properties=properties)
        ccu = spark.read.jdbc(url, _PG_CCU, predicates=cpreds, properties=properties)
        pk = catalog_pk_join(tc, kcu).withColumnRenamed("constraint_schema", "db_name")
        fk = catalog_fk_join(tc, kcu, ccu).withColumnRenamed("constraint_schema", "db_name")
        return cols, pk, fk
    raise ValueError(f"unsupported database type: {db_type}")


def table_count(columns: DataFrame, db="db_id") -> DataFrame:
    """Number of tables per database."""
    return columns.groupBy(db).agg(F.countDistinct("table_name").alias("n_tables"))


def apply_blacklist(columns: DataFrame, blacklist) -> DataFrame:
    """drop blacklisted tables (exact, case-sensitive).  A list becomes an
    IN-set filter (no join); a DataFrame (table_name[, db_id]) an anti join."""
    if isinstance(blacklist, (list, tuple, set)):
        return columns.where(~F.col("table_name").isin(*sorted(blacklist))) if blacklist else columns
    keys = [c for c in ("db_id", "table_name") if c in blacklist.columns]
    return columns.join(blacklist.select(*keys), keys, "left_anti")


def catalog_pk_join(tc: DataFrame, kcu: DataFrame) -> DataFrame:
    """J2 (Postgres shape): constraints ⋈ key usage on (constraint, schema), PRIMARY KEY only."""
    t = tc.where(F.col("constraint_type") == "PRIMARY KEY").select("constraint_schema", "constraint_name")
    return t.join(kcu, ["constraint_schema", "constraint_name"]).select(
        "constraint_schema", "table_name", "column_name", "ordinal_position")


def catalog_fk_join(tc: DataFrame, kcu: DataFrame, ccu: DataFrame) -> DataFrame:
    """Constraints ⋈ key usage ⋈ constraint column usage, FOREIGN KEY only.
    Multi-column keys cross-multiply; the reference keeps the last row per
    column, made deterministic here as the greatest (ref_table, ref_column)."""
    t = tc.where(F.col("constraint_type") == "FOREIGN KEY").select("constraint_schema", "constraint_name")
    k = kcu.select("constraint_schema", "constraint_name", "table_name", "column_name")
    c = ccu.select("constraint_schema", "constraint_name", F.col("table_name").alias("ref_table"),
                   F.col("column_name").alias("ref_column"))
    j = t.join(k, ["constraint_schema", "constraint_name"]).join(c, ["constraint_schema", "constraint_name"])
    g = j.groupBy("constraint_schema", "table_name", "column_name").agg(
        F.max(F.struct("ref_table", "ref_column")).alias("r"))
    return g.select("constraint_schema", "table_name", "column_name", "r.ref_table", "r.ref_column")


def columns_by_table(columns: DataFrame, db="db_id") -> DataFrame:
    """A1: per table, its columns in ordinal order as an array of structs."""
    s = F.struct(F.col("ordinal_position").cast("int").alias("position"),
                 F.col("column_name").alias("name"), F.col("data_type").alias("type"),
                 F.col("column_type"), (F.col("is_nullable") == "YES").alias("nullable"),
                 F.col("column_key").alias("key"), F.coalesce(F.col("column_comment"), F.lit("")).alias("comment"))
    g = columns.groupBy(db, "table_name").agg(F.sort_array(F.collect_list(s)).alias("cols"))
    return g.select(db, "table_name", F.transform("cols", lambda c: F.struct(
        c["name"].alias("name"), c["type"].alias("type"), c["column_type"].alias("column_type"),
        c["nullable"].alias("nullable"), c["key"].alias("key"), c["comment"].alias("comment"),
        c["position"].alias("position"))).alias("columns"))


def pk_by_table(pk: DataFrame, db="db_id") -> DataFrame:
    """A2: primary-key column names per table in ordinal order."""
    g = pk.groupBy(db, "table_name").agg(
        F.sort_array(F.collect_list(F.struct("ordinal_position", "column_name"))).alias("k"))
    return g.select(db, "table_name", F.transform("k", lambda x: x["column_name"]).alias("primary_keys"))


def fk_map(fk: DataFrame, db="db_id") -> DataFrame:
    """A3: column → "ref_table.ref_column" per table (one entry per column, ordered by column)."""
    one = fk.groupBy(db, "table_name", "column_name").agg(
        F.max(F.concat_ws(".", "ref_table", "ref_column")).alias("ref"))
    g = one.groupBy(db, "table_name").agg(F.sort_array(F.collect_list(F.struct("column_name", "ref"))).alias("e"))
    return g.select(db, "table_name", F.map_from_entries("e").alias("foreign_keys"))


def assemble_catalog(columns: DataFrame, pk: DataFrame, fk: DataFrame, db="db_id",
                     blacklist=()) -> DataFrame:
    """(db_id, table_name, columns, primary_keys, foreign_keys); tables
    without keys get ``[]`` / ``{}``.  Only tables that have columns appear."""
    cols = columns_by_table(apply_blacklist(columns, blacklist), db)
    j = cols.join(pk_by_table(pk, db), [db, "table_name"], "left").join(fk_map(fk, db), [db, "table_name"], "left")
    return j.select(db, "table_name", "columns",
                    F.coalesce("primary_keys", F.array().cast("array<string>")).alias("primary_keys"),
                    F.coalesce("foreign_keys", F.create_map().cast("map<string,string>")).alias("foreign_keys"))


# ------------------------------------------------------------------ cards

def table_summary() -> Column:
    """N13 over an assembled catalog row."""
    n = F.size("columns").cast("string")
    fk = F.when(F.size(F.map_keys("foreign_keys")) > 0, F.lit(HAS_FK)).otherwise(F.lit(""))
    head, tail = COLUMN_COUNT.split("{n}")
    return F.concat(F.col("table_name"), F.lit(TABLE_SUFFIX), F.lit(head), n, F.lit(tail), fk, F.lit(SENTENCE_END))


def _col_type(c: Column) -> Column:
    return F.coalesce(F.nullif(c["column_type"], F.lit("")), c["type"])


def simplified_columns() -> Column:
    """[{name, type (upper-cased), desc}] — desc = PK mark, comment and
    required mark joined by '，', or the column type when all are absent."""
    pks = F.col("primary_keys")

    def one(c):
        is_pk = F.array_contains(pks, c["name"])
        desc = F.concat_ws(DESC_SEP,
                           F.when(is_pk, F.lit(PK_MARK)),
                           F.when(F.coalesce(c["comment"], F.lit("")) != "", c["comment"]),
                           F.when(~c["nullable"] & ~is_pk, F.lit(REQUIRED_MARK)))
        t = _col_type(c)
        return F.struct(c["name"].alias("name"), F.upper(t).alias("type"),
                        F.when(desc == "", t).otherwise(desc).alias("desc"))
    return F.transform("columns", one)


def table_cards(catalog: DataFrame, db="db_id") -> DataFrame:
    """(db_id, table_name, summary, columns, foreign_keys)."""
    return catalog.select(db, "table_name", table_summary().alias("summary"),
                          simplified_columns().alias("columns"), "foreign_keys")


def _fk_lines(prefix: str) -> Column:
    return F.transform(F.map_entries("foreign_keys"),
                       lambda e: F.concat(F.lit(prefix), e["key"], F.lit(" -> "), e["value"]))


def card_text() -> Column:
    """One table's block of the cards text (lines joined by newline)."""
    lines = F.concat(
        F.array(F.concat(F.lit(CARD_HEADER), F.col("table_name")),
                F.concat(F.lit(CARD_SUMMARY), F.col("summary")), F.lit(CARD_COLUMNS)),
        F.transform("columns", lambda c: F.concat(F.lit("  - "), c["name"], F.lit(" ("), c["type"],
                                                  F.lit("): "), c["desc"])),
        F.when(F.size(F.map_keys("foreign_keys")) > 0,
               F.concat(F.array(F.lit(CARD_FKS)), _fk_lines("  - "))).otherwise(F.array().cast("array<string>")))
    return F.array_join(lines, "\n")


def cards_text(cards: DataFrame, db="db_id") -> DataFrame:
    """Per database, all table blocks in table-name order."""
    g = cards.groupBy(db).agg(F.sort_array(F.collect_list(F.struct("table_name", card_text().alias("b")))).alias("t"))
    return g.select(db, F.array_join(F.transform("t", lambda x: x["b"]), "\n").alias("cards_text"))


def cards_json(cards: DataFrame, db="db_id") -> DataFrame:
    """K6: per database, the cards document {table: {summary, columns, foreign_keys}}."""
    card = F.struct("summary", "columns", "foreign_keys")
    by_name = lambda a, b: (F.when(a["table_name"] < b["table_name"], -1)
                            .when(a["table_name"] > b["table_name"], 1).otherwise(0))
    g = cards.groupBy(db).agg(F.array_sort(F.collect_list(F.struct("table_name", card.alias("card"))), by_name)
                              .alias("t"))
    return g.select(db, F.to_json(F.map_from_entries("t")).alias("cards_json"))


def catalog_json(catalog: DataFrame, db="db_id") -> DataFrame:
    """K6: per database, the catalog document {table: {columns, primary_keys, foreign_keys}}, tables by name."""
    entry = F.struct("columns", "primary_keys", "foreign_keys")
    by_name = lambda a, b: (F.when(a["table_name"] < b["table_name"], -1)
                            .when(a["table_name"] > b["table_name"], 1).otherwise(0))
    g = catalog.groupBy(db).agg(F.array_sort(F.collect_list(F.struct("table_name", entry.alias("entry"))), by_name).alias("t"))
    return g.select(db, F.to_json(F.map_from_entries("t")).alias("catalog_json"))


# ------------------------------------------------------------------ DDL

def table_ddl(catalog: DataFrame, db="db_id") -> DataFrame:
    """Per table: simplified CREATE TABLE text (column_type as stored, NOT NULL,
    COMMENT, PRIMARY KEY) plus foreign keys as comment lines."""
    defs = F.transform("columns", lambda c: F.concat(
        F.lit("  "), c["name"], F.lit(" "), F.coalesce(c["column_type"], F.lit("")),
        F.when(~c["nullable"], F.lit(" NOT NULL")).otherwise(F.lit("")),
        F.when(F.coalesce(c["comment"], F.lit("")) != "",
               F.concat(F.lit(" COMMENT '"), c["comment"], F.lit("'"))).otherwise(F.lit(""))))
    pk = F.when(F.size("primary_keys") > 0,
                F.array(F.concat(F.lit("  PRIMARY KEY ("), F.array_join("primary_keys", ", "), F.lit(")")))
                ).otherwise(F.array().cast("array<string>"))
    body = F.array_join(F.concat(defs, pk), ",\n")
    fks = F.when(F.size(F.map_keys("foreign_keys")) > 0,
                 F.concat(F.array(F.lit(DDL_FK_HEADER)), _fk_lines("--   "))).otherwise(F.array().cast("array<string>"))
    lines = F.concat(F.array(F.concat(F.lit("\nCREATE TABLE "), F.col("table_name"), F.lit(" (")), body, F.lit(");")),
                     fks)
    return catalog.select(db, "table_name", F.array_join(lines, "\n").alias("ddl"))


def topic_ddl(topics: DataFrame, ddl: DataFrame, keys=("plan_id", "ord"), db="db_id") -> DataFrame:
    """Per topic, DDL of its tables in topic order; unknown tables skipped."""
    t = topics.select(*keys, db, F.posexplode("tables").alias("i", "table_name"))
    j = t.join(ddl, [db, "table_name"], "inner")
    g = j.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("i", "ddl"))).alias("d"))
    g = g.select(*keys, F.array_join(F.transform("d", lambda x: x["ddl"]), "\n").alias("ddl"))
    # topics whose tables are all unknown still get a (blank) DDL text
    return (topics.select(*keys).join(g, list(keys), "left")
            .select(*keys, F.coalesce("ddl", F.lit("")).alias("ddl")))
