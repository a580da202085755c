"""V7: unqualified column names bound in nested scopes.

Every bracket is an interval of token numbers, and every SELECT opens a block
inside its bracket.  A relation (table, derived table or WITH name) is visible
in the interval of its block; before the first SELECT of a bracket (INSERT,
UPDATE, DELETE, MERGE) in the whole bracket.  A name is bound in the nearest
enclosing block that offers the column, so subqueries see the tables around
them; bodies of derived tables (but LATERAL ones) and of WITH names see nothing
outside themselves.

A derived table or WITH name offers the names that end its select items; a
``*`` in it offers the columns of its tables.  A ``*`` over another derived
table may offer anything.

The statement's arrays (relations, references, outputs) are bounded by its own
tokens.  References meet the catalog once, by (database, name), where each name
has the array of the database's tables that hold such a column.

Limits of the token rules: bracketed join lists, WITH names with a column list
and column aliases of derived tables are not followed.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import validation as V
from .walk import ints, structs

# --- fixed values -------------------------------------------------------------
#: Statements whose bare names are looked up.
VERBS = ("SELECT", "WITH", "INSERT", "REPLACE", "UPDATE", "DELETE", "MERGE", "EXPLAIN", "(")
#: Words that are no names though the lexer's keyword list lacks them.
WORDS = ("RECURSIVE", "LATERAL", "ROWS", "RANGE", "PRECEDING", "FOLLOWING", "UNBOUNDED", "NOWAIT", "DUPLICATE", "KEY",
         "MATCHED", "SEPARATOR", "NULLS", "FOR", "ESCAPE", "ILIKE", "DO", "NOTHING", "CONFLICT", "RETURNING", "ANALYZE",
         "VERBOSE", "EXTENDED", "TEMPORARY")
#: Tokens that end a select item.
ENDS = (",", "FROM", ")", ";", "UNION", "EXCEPT", "INTERSECT", "WHERE", "ORDER", "LIMIT")
# --- end of fixed values ------------------------------------------------------


def _alias_place(w: V.Rules) -> np.ndarray:
    """A name right after a value, a table or AS names it."""
    return w.is_id[w.near(-1)] | w.p(1, "AS", ")", "END") | w.literal(w.near(-1))


def _reference(w: V.Rules) -> np.ndarray:
    no_name = w.among(w.kw[:-1], *V.VERBS, *V.CLAUSES, *WORDS, "IS DISTINCT FROM", "DISTINCT ON")
    unit = w.p(1, "(") & w.among(w.kw[w.near(1)], "FROM")  # EXTRACT(YEAR FROM …)
    return (w.is_id[:-1] & ~w.is_tref & ~_alias_place(w) & ~w.p(1, ".")
            & ~w.next_is(1, ".", "(") & ~w.quote(w.near(1)) & ~no_name & ~unit & ~w.is_cte)


_SPOT = "_i:int,slo:int,lo:int,hi:int"
_FOUND = {
    "brackets": "lo:int,hi:int,lateral:boolean,joins:boolean", "trefs": f"{_SPOT},table_name:string,alias:string",
    "derived": f"{_SPOT},name:string,ends:int", "ctes": "_i:int,name:string,opens:int",
    "outs": f"{_SPOT},name:string,is_alias:boolean", "stars": f"{_SPOT},qualifier:string", "names": f"{_SPOT},pos:bigint,name:string"}


def _bindings(w: V.Rules) -> list:
    """The first word and the arrays of ``_FOUND``, per statement."""
    b, select = w.blocks(), w.among(w.clause, "SELECT")
    before = w.kw[w.near(-1)]
    ends_item = (w.near(1) == w.n) | w.among(w.kw[w.near(1)], *ENDS)

    def spot(at: np.ndarray) -> dict:
        return {"_i": ints(w.i[at]), **{n: ints(b[n][at]) for n in ("slo", "lo", "hi")}}

    def after(at: np.ndarray, word: str) -> pa.Array:
        return pa.array(w.among(before, word)[at], mask=before[at] < 0)

    def qualifier(at: np.ndarray) -> pa.Array:
        words = w.word(np.where(w.p(1, "."), w.kw[w.near(-2)], -1)[at]).to_pylist()
        return pa.array([None if x is None else re.sub('^["`]|["`]$', "", x.lower()) for x in words], pa.string())
    found = {
        "brackets": (w.among(w.up[:-1], "("), lambda at: {"lo": ints(w.i[at]), "hi": ints(b["shi"][at]), "lateral": after(at, "LATERAL"),
                                                          "joins": after(at, "USING")}),
        "trefs": (w.is_tref, lambda at: spot(at) | w.tref_fields(at)),
        "derived": (w.is_derived, lambda at: spot(at) | {"name": w.names(at), "ends": ints(w.i[at] - np.where(w.p(1, ")")[at], 2, 3))}),
        "ctes": (w.is_cte, lambda at: {"_i": ints(w.i[at]), "name": w.names(at), "opens": ints(w.i[at] + 2)}),
        "outs": (w.is_id[:-1] & select & ends_item, lambda at: spot(at) | {"name": w.names(at), "is_alias": _alias_place(w)[at]}),
        "stars": (w.among(w.up[:-1], "*") & select & w.p(1, "SELECT", "DISTINCT", "ALL", ",", "."),
                  lambda at: spot(at) | {"qualifier": qualifier(at)}),
        "names": (_reference(w), lambda at: spot(at) | {"pos": w.pos[at], "name": w.names(at)}),
    }
    places = {n: np.flatnonzero(cond) for n, (cond, _) in found.items()}
    return [w.words_of(w.offsets[w.some])] + [w.lists(places[n], structs(**fields(places[n]))) for n, (_, fields) in found.items()]


def binding_summary(samples: DataFrame, key="sample_id", sql="output", db="db_id") -> DataFrame:
    """One row per statement: brackets, table references, derived tables, WITH names, outputs, stars and bare names."""
    made = "verb string, " + ", ".join(f"{n} array<struct<{f}>>" for n, f in _FOUND.items())
    t = V.statement_frame(samples.select(key, db, sql), made, _bindings, key, sql, keep=(db,))
    g = t.select(key, db, "verb", *[F.sort_array(n).alias(n) for n in _FOUND])
    return V.fenced(g, key, db).where(F.col("verb").isin(*VERBS))


#: Relations with the interval they are visible in and, for derived tables and WITH names, their body's bracket.
_RELATIONS = """
concat(
  transform(filter(trefs, t -> not exists(ctes, c -> c.name = t.table_name)), t -> named_struct(
    'id', t._i, 'slo', t.slo, 'lo', t.lo, 'hi', t.hi, 'relation', coalesce(t.alias, t.table_name), 'table', t.table_name, 'body', -1)),
  flatten(transform(trefs, t -> transform(slice(filter(ctes, c -> c.name = t.table_name), 1, 1), c -> named_struct(
    'id', t._i, 'slo', t.slo, 'lo', t.lo, 'hi', t.hi, 'relation', coalesce(t.alias, t.table_name), 'table', cast(null as string), 'body', c.opens)))),
  flatten(transform(derived, d -> transform(filter(brackets, b -> b.hi = d.ends), b -> named_struct(
    'id', d._i, 'slo', d.slo, 'lo', d.lo, 'hi', d.hi, 'relation', d.name, 'table', cast(null as string), 'body', b.lo)))))
"""
#: Brackets whose inside sees nothing outside.
_WALLS = """
filter(brackets, b -> not coalesce(b.lateral, false) and (exists(ctes, c -> c.opens = b.lo) or exists(derived, d -> d.ends = b.hi)))
"""
#: Relations that a bare name can see: what they surely offer, the tables whose columns they offer, and whether they may offer anything.
_VISIBLE = """
transform(
  filter(relations, r -> r.lo <= n._i and n._i <= r.hi
         and r.lo >= coalesce(array_max(transform(filter(walls, w -> w.lo < n._i and n._i <= w.hi), w -> w.lo)), -1)),
  r -> named_struct('id', r.id, 'lo', r.lo, 'relation', r.relation,
    'sure', exists(outs, o -> r.body >= 0 and o.slo = r.body and o.name = n.name),
    'tables', if(r.body < 0, array(r.table), flatten(transform(filter(stars, s -> s.slo = r.body), s -> transform(
        filter(relations, x -> x.lo = s.lo and x.table is not null and coalesce(s.qualifier = x.relation, true)), x -> x.table)))),
    'open', exists(stars, s -> s.slo = r.body
                   and exists(relations, x -> x.lo = s.lo and x.table is null and coalesce(s.qualifier = x.relation, true))),
    'merged', exists(names, m -> m.name = n.name and m.lo > r.lo and m._i <= r.hi and exists(brackets, b -> b.joins and b.lo = m.slo))))
"""


def unqualified_refs(summary: DataFrame, catalog_columns: DataFrame, key="sample_id", db="db_id") -> DataFrame:
    """(key, pos, column_name, status, relation, anywhere) of every bare name.

    ``status``: ``bound`` (to ``relation``), ``merged`` (a USING column of several), ``ambiguous`` (several
    relations of the nearest block offer it), ``unknown`` (only a ``*`` over a derived table may), ``alias``
    (a select item of the block has that name) or ``unresolved``.  ``anywhere``: some table of the statement
    has such a column, whatever the scopes."""
    s = summary.withColumn("relations", F.expr(_RELATIONS)).withColumn("walls", F.expr(_WALLS))
    found = f"""transform(names, n -> named_struct('pos', n.pos, 'column_name', n.name, 'visible', {_VISIBLE},
        'is_alias', exists(outs, o -> o.is_alias and o.lo = n.lo and o.name = n.name)))"""
    refs = s.select(key, db, F.transform("trefs", lambda t: t["table_name"]).alias("all_tables"), F.inline(F.expr(found)))
    holders = (catalog_columns.select(db, F.lower("column_name").alias("column_name"), F.lower("table_name").alias("table_name"))
               .groupBy(F.col(db).alias("_db"), F.col("column_name").alias("_name")).agg(F.collect_set("table_name").alias("holders")))
    refs = refs.join(holders, (F.col(db) == F.col("_db")) & (F.col("column_name") == F.col("_name")), "left")
    refs = refs.withColumn("holders", F.coalesce("holders", F.array().cast("array<string>")))
    refs = refs.withColumn("offers", F.expr("filter(visible, v -> v.sure or arrays_overlap(v.tables, holders))"))
    refs = refs.withColumn("nearest", F.expr("array_max(transform(filter(visible, v -> v.open or v.sure or arrays_overlap(v.tables, holders)), v -> v.lo))"))
    refs = refs.withColumn("offers", F.expr("filter(offers, v -> v.lo = nearest)"))
    status = (F.when(F.size("offers") == 1, F.lit("bound"))
              .when(F.size("offers") > 1, F.when(F.expr("offers[0].merged"), F.lit("merged")).otherwise(F.lit("ambiguous")))
              .when(F.col("nearest").isNotNull(), F.lit("unknown")).when(F.col("is_alias"), F.lit("alias")).otherwise(F.lit("unresolved")))
    return refs.select(key, "pos", "column_name", status.alias("status"),
                       F.when(F.size("offers") == 1, F.expr("offers[0].relation")).alias("relation"),
                       F.arrays_overlap("all_tables", "holders").alias("anywhere"))
