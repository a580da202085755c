"""Validation of generated SQL against database catalogs.

Re-aim of a per-row grammar parser as a token table: each statement is lexed
once (a built-in regex) and stays one row, its tokens being an array.  Token
neighbours, bracket depth, scope and clause of a whole batch of statements are
worked out together (``walk``), so that no token is ever sorted, shuffled or
spilled.  Samples are hash-partitioned by their key once; statements that share
a key are taken as one, their tokens ordered by position.  The summary holds
the sample's row, syntax figures and references, so that verdicts need no
second look at samples or tokens: only distinct names meet the catalog, and the
few missing ones join back.

Rules (weaker than a grammar — documented limits):

* syntax (V2): known leading verb, parentheses balanced and never negative,
  no unterminated quote, no clause keyword dangling at the end, no SELECT
  directly followed by FROM;
* table reference (V3): an identifier after FROM/JOIN/INTO/UPDATE, after
  USING of a MERGE or DELETE, after [DROP|TRUNCATE|ALTER] TABLE [IF EXISTS] or
  TRUNCATE, or after a comma while the clause at the same bracket scope is
  FROM/JOIN/ON/USING/UPDATE or DROP/TRUNCATE TABLE, unless
  a bracket follows (a table function; INTO t (columns) is a table); FROM in
  IS [NOT] DISTINCT FROM, ON in DISTINCT ON, and UPDATE in ON DUPLICATE KEY
  UPDATE, FOR UPDATE or ON UPDATE do not count; for
  FROM/JOIN/USING/comma a SELECT, DELETE, UPDATE or MERGE must occur earlier in
  the same bracket scope (so ``EXTRACT(YEAR FROM x)`` is not a table).
  ``db.t`` names ``t``.  Alias = next identifier, skipping AS;
* column reference (V4): ``q.c`` / ``q.*`` outside table references, not
  followed by a bracket (a function);
* alias resolution (J7): last alias wins; a bare table name resolves to itself;
* names bound by WITH and derived-table aliases are accepted unless
  ``strict=True`` (the reference rejects them as unknown tables).
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import SQL_KEYWORDS, WS_CLASS, is_blank, py_strip, sql_lex, sql_pieces
from .walk import Walk, ints, structs, walked

# --- fixed values ------------------------------------------------------------
VERBS = ("SELECT", "WITH", "INSERT", "UPDATE", "DELETE", "CREATE", "DROP", "ALTER", "REPLACE",
         "MERGE", "SHOW", "DESCRIBE", "DESC", "EXPLAIN", "USE", "SET", "VALUES", "TRUNCATE", "(")
CLAUSES = ("SELECT", "FROM", "JOIN", "WHERE", "GROUP", "ORDER", "HAVING", "LIMIT", "OFFSET", "ON",
           "USING", "SET", "INTO", "VALUES", "UPDATE", "UNION", "EXCEPT", "INTERSECT", "WITH",
           "DELETE", "INSERT", "MERGE", "UPDATE OPTION", "TABLE LIST", "TABLE NAME")
#: Clauses in which a comma leads to a further table.
LISTS = ("FROM", "JOIN", "ON", "USING", "UPDATE", "TABLE LIST")
DANGLING = ("SELECT", "FROM", "WHERE", "JOIN", "ON", "BY", "GROUP", "ORDER", "HAVING", "AND", "OR",
            "NOT", "SET", "INTO", "VALUES", "AS", "UNION", "LIMIT", "OFFSET", "IN", "LIKE", "BETWEEN",
            "IS", "CASE", "WHEN", "THEN", "ELSE", "USING", ",", "=", "<", ">", "+", "-", "/")
TABLE_PREV = ("FROM", "JOIN", "INTO", "UPDATE")
MSG_SYNTAX = "语法错误: "                 # syntax error:
MSG_TABLE = "Schema错误: 表 '{t}' 不存在"   # schema error: table 't' does not exist
MSG_COLUMN = "Schema错误: 字段 '{t}.{c}' 不存在"  # schema error: column 't.c' does not exist
# --- end of fixed values ------------------------------------------------------
MSG_EXECUTION = "execution failed: "

STAGE_SYNTAX, STAGE_TABLE, STAGE_COLUMN, STAGE_EXECUTION = 1, 2, 3, 4


def _msg(template: str, **cols: Column) -> Column:
    parts, rest = [], template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        parts += [F.lit(head), cols[name]]
    parts.append(F.lit(rest))
    return F.concat(*parts)


_WORD = r"^[\p{L}\p{N}_]+$"


def _lexed(text: Column) -> Column:
    """The significant tokens of one text: array of (pos, tok, up, is_id, name, delta)."""
    tokens = F.transform(sql_lex(text), lambda x, i: F.struct(i.cast("bigint").alias("pos"), x.alias("tok")))
    # drop whitespace runs and comments (no other token starts with whitespace)
    tokens = F.filter(tokens, lambda x: ~(x["tok"].rlike("^" + WS_CLASS) | x["tok"].startswith("--") | x["tok"].startswith("/*")))

    def features(x: Column) -> Column:
        t = x["tok"]
        up = F.upper(t)
        is_word = t.rlike(_WORD)
        quoted = (t.startswith('"') | t.startswith("`")) & (F.length(t) >= 2)
        is_id = (is_word & ~up.isin(*SQL_KEYWORDS) & ~t.rlike("^[0-9]")) | quoted
        name = F.when(quoted, F.lower(F.substr(t, F.lit(2), F.length(t) - 2))).otherwise(F.lower(t))
        delta = F.when(t == "(", 1).when(t == ")", -1).otherwise(0)
        return F.struct(x["pos"].alias("pos"), t.alias("tok"), up.alias("up"), is_id.alias("is_id"), name.alias("name"),
                        delta.alias("delta"))

    return F.transform(tokens, features)


def fenced(df: DataFrame, *keys) -> DataFrame:
    """The same rows, the columns other than ``keys`` made by a generator of one row
    each.  A filter is not pushed below a generator, where it would compute the
    arrays it reads once more, step by step."""
    return df.select(*keys, F.inline_outer(F.array(F.struct(*[c for c in df.columns if c not in keys]))))


class Rules(Walk):
    """The tokens of a batch of statements with what the rules say of each: its clause
    and what its scope has seen, and whether it starts a reference or names a relation."""

    @cached_property
    def clause(self) -> np.ndarray:
        return self.clause_of(CLAUSES)

    @cached_property
    def sel_seen(self) -> np.ndarray:
        return self.seen("SELECT", "DELETE")

    @cached_property
    def mut_seen(self) -> np.ndarray:
        return self.seen("DELETE", "UPDATE", "MERGE")

    def p(self, by: int, *words: str) -> np.ndarray:
        """Whether the token ``by`` before is one of ``words``, as a clause word."""
        return self.among(self.kw[self.near(-by)], *words)

    def next_is(self, by: int, *words: str) -> np.ndarray:
        return self.among(self.up[self.near(by)], *words)

    @cached_property
    def dotted(self) -> np.ndarray:
        return self.next_is(1, ".") & self.is_id[self.near(2)]

    @cached_property
    def is_tref(self) -> np.ndarray:
        """V3: the token starts a table reference."""
        seen = self.sel_seen | self.mut_seen
        lists = self.among(self.clause, "TABLE LIST")
        prev_ok = (self.p(1, "INTO", "UPDATE", "TRUNCATE", "TABLE LIST", "TABLE NAME")
                   | (self.p(1, "EXISTS") & self.p(2, "IF") & self.among(self.clause, "TABLE LIST", "TABLE NAME"))
                   | (self.p(1, *TABLE_PREV) & seen)
                   | (self.p(1, "USING") & self.mut_seen)
                   | (self.p(1, ",") & self.among(self.clause, *LISTS) & (seen | lists)))
        after = np.where(self.dotted, self.near(3), self.near(1))
        call = self.among(self.up[after], "(") & ~self.p(1, "INTO")  # a table function; INTO t (columns) is none
        return self.is_id[:-1] & prev_ok & ~call

    def tref_fields(self, at: np.ndarray) -> dict:
        q, near = self.dotted[at], lambda by: self.near(by)[at]
        # token after the name, then the one after that (for AS)
        a1, a2 = np.where(q, near(3), near(1)), np.where(q, near(4), near(2))
        alias = np.where(self.among(self.kw[a1], "AS"), np.where(self.is_id[a2], a2, self.n), np.where(self.is_id[a1], a1, self.n))
        return {"table_name": self.names(np.where(q, near(2), at)), "alias": self.names(alias)}

    @cached_property
    def is_cref(self) -> np.ndarray:
        """V4: the token starts a column reference."""
        two = self.next_is(1, ".") & (self.is_id[self.near(2)] | self.next_is(2, "*"))
        call = self.next_is(3, "(")  # q.f(…) is a function
        return self.is_id[:-1] & two & ~call & ~self.p(1, ".") & ~self.is_tref

    def cref_fields(self, at: np.ndarray) -> dict:
        n2, n4 = self.near(2)[at], self.near(4)[at]
        three = (self.next_is(3, ".") & (self.is_id[self.near(4)] | self.next_is(4, "*")))[at] & self.is_id[n2]
        return {"qualifier": self.names(np.where(three, n2, at)), "column_name": self.names(np.where(three, n4, n2))}

    @cached_property
    def is_cte(self) -> np.ndarray:
        return (self.is_id[:-1] & self.among(self.kw[self.near(1)], "AS") & self.next_is(2, "(")
                & (self.p(1, "WITH", "RECURSIVE") | (self.p(1, ",") & (self.depth == 0) & ~self.sel_seen)))

    @cached_property
    def is_derived(self) -> np.ndarray:
        return (self.is_id[:-1] & self.among(self.clause, "FROM", "JOIN", "USING", "UPDATE")
                & (self.p(1, ")") | (self.p(1, "AS") & self.p(2, ")"))))

    def figures(self) -> dict:
        """What the syntax rules need, per statement; null without tokens."""
        ends = self.offsets[1:][self.some] - 1
        first_pos = lambda at: self.numbers(np.append(self.pos, 0)[at], at == self.n)
        return {"first": self.words_of(self.offsets[self.some]),
                "min_cum": self.numbers(np.minimum.reduceat(self.cum, self.offsets[self.some]) if self.n else ends),
                "final_cum": self.numbers(self.cum[ends]),
                "last": self.words_of(self.last_place(~self.among(self.up[:-1], ";"))),
                "quote_pos": first_pos(self.first_place(self.among(self.up[:-1], "'", '"', "`"))),
                "sf_pos": first_pos(self.first_place(self.among(self.kw[:-1], "SELECT") & self.among(self.kw[self.near(1)], "FROM")))}

    def highest_at_end(self) -> pa.Array:
        """Statements that share a key end at the same place, at several levels: the highest of them."""
        ends = self.offsets[1:][self.some] - 1
        if not self.n:
            return self.numbers(ends)
        last = np.repeat(self.pos[ends], np.diff(self.offsets)[self.some])
        return self.numbers(np.maximum.reduceat(np.where(self.pos == last, self.cum, self.cum.min()), self.offsets[self.some]))


_FIGURES = "first string, min_cum bigint, final_cum bigint, last string, quote_pos bigint, sf_pos bigint"
_TREF, _CREF = "table_name string, alias string", "qualifier string, column_name string"


def _own_figures(w: Rules) -> pa.Array:
    """A statement's syntax figures at its first token."""
    owner = np.full(w.n, -1)
    owner[w.offsets[w.some]] = w.some
    return structs(**w.figures()).take(pa.array(owner, pa.int64(), mask=owner < 0))


def _where(cond: np.ndarray, fields) -> pa.Array:
    """The structs ``fields`` of the tokens with ``cond``; null for the others."""
    at = np.flatnonzero(cond)
    nth = np.cumsum(cond) - 1
    return structs(**fields(at)).take(pa.array(nth, pa.int64(), mask=~cond))


#: What a token row can have: type, and how a batch's values are made.
TOKEN = {
    "_i": ("int", lambda w: ints(w.i)), "pos": ("bigint", lambda w: pa.array(w.pos)), "tok": ("string", lambda w: w.texts(w.near(0))),
    "up": ("string", lambda w: w.word(w.up[:-1])), "is_id": ("boolean", lambda w: pa.array(w.is_id[:-1])),
    "name": ("string", lambda w: w.names(w.near(0))), "delta": ("int", lambda w: ints(w.delta)),
    "kw": ("string", lambda w: w.word(w.kw[:-1])), "p1": ("string", lambda w: w.word(w.kw[w.near(-1)])),
    "p2": ("string", lambda w: w.word(w.kw[w.near(-2)])), "p1_id": ("boolean", lambda w: pa.array(w.is_id[w.near(-1)])),
    **{f"n{k}{s}": (t, (lambda f, k: lambda w: f(w, w.near(k)))(f, k)) for k in (1, 2, 3, 4) for s, t, f in (
        ("", "string", lambda w, at: w.texts(at)), ("_up", "string", lambda w, at: w.word(w.kw[at])),
        ("_id", "boolean", lambda w, at: pa.array(w.is_id[at])), ("_name", "string", lambda w, at: w.names(at)))},
    "cum": ("bigint", lambda w: pa.array(w.cum)), "depth": ("bigint", lambda w: pa.array(w.depth)),
    "scope": ("bigint", lambda w: pa.array(w.scope)), "clause": ("string", lambda w: w.word(w.clause)),
    "sel_seen": ("boolean", lambda w: pa.array(w.sel_seen)), "mut_seen": ("boolean", lambda w: pa.array(w.mut_seen)),
    "tref": (f"struct<{_TREF}>", lambda w: _where(w.is_tref, w.tref_fields)),
    "cref": (f"struct<{_CREF}>", lambda w: _where(w.is_cref, w.cref_fields)),
    "binds": ("boolean", lambda w: pa.array(w.is_cte | w.is_derived)), "syntax": (f"struct<{_FIGURES}>", _own_figures),
}


def _one_per_key(samples: DataFrame, key, sql, keep) -> DataFrame:
    """(key, keep…, blank, _texts): a row per key with the stripped texts of its
    samples (in order of their texts); ``keep`` is the first one's."""
    s = samples.select(key, *keep, F.col(sql).alias("_sql")).repartition(key)
    w = Window.partitionBy(key).orderBy("_sql")
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("_texts", F.collect_list(F.coalesce("_sql", F.lit(""))).over(every)).withColumn("_nth", F.row_number().over(w))
    s = s.where("_nth = 1")
    return s.select(key, *keep, F.exists("_texts", is_blank).alias("blank"), F.transform("_texts", py_strip).alias("_texts"))


def statement_frame(samples: DataFrame, made: str, columns, key="sample_id", sql="output", keep=("db_id",)) -> DataFrame:
    """(key, keep…, blank, made…): one row per statement with what ``columns`` makes
    of its significant tokens (no whitespace, no comments; none for blank ones), a
    list of Arrow columns from the :class:`Rules` of a batch; ``made`` has their
    names and types.

    ``kw`` is the upper-cased token, except where a clause word is none (FROM in
    IS [NOT] DISTINCT FROM, ON in DISTINCT ON, and UPDATE other than a
    statement's verb: after nothing, a bracket, a semicolon or EXPLAIN) or TABLE
    names tables (after DROP, TRUNCATE: a list; after ALTER: one).

    Tokens at depth d inside the n-th bracket that opened level d share scope
    (d, n).  A '(' is placed in the scope it opens (level ``cum``); its own
    clause/scope values are never read and it is never a clause word, so this
    changes nothing else."""
    s = _one_per_key(samples, key, sql, keep)
    return walked(s.select(key, *keep, "blank", F.transform("_texts", sql_pieces).alias("_lexed")), made, lambda lexed: columns(Rules(lexed)))


def sql_tokens(samples: DataFrame, key="sample_id", sql="output", keep=("db_id",), outer: bool = False,
               neighbours: bool = True, fields=tuple(TOKEN)) -> DataFrame:
    """V1: one row per significant token (no whitespace, no comments) with its
    position, features and, with ``neighbours``, all that ``Rules`` knows of it
    (``TOKEN``; ``fields`` names what is needed of that, besides the position and
    level); a statement's first row then has its syntax figures.
    Blank statements produce no tokens (one empty row with ``outer``)."""
    if not neighbours:
        # an inner generator would get a filter on the array's size below it, with a second lexer
        some = F.lit(True) if outer else F.col("pos").isNotNull()
        s = samples.repartition(key).select(key, *keep, is_blank(sql).alias("blank"), F.coalesce(F.col(sql), F.lit("")).alias("_sql"))
        return s.select(key, *keep, "blank", F.inline_outer(_lexed(py_strip("_sql")))).where(some)
    fields = [f for f in TOKEN if f in fields or f in ("pos", "cum")]

    def tokens(w: Rules) -> list:
        return [w.lists(w.near(0), structs(**{f: TOKEN[f][1](w) for f in fields}))]
    s = statement_frame(samples, f"toks array<struct<{','.join(f'{f}:{TOKEN[f][0]}' for f in fields)}>>", tokens, key, sql, keep)
    return s.select(key, *keep, "blank", (F.inline_outer if outer else F.inline)("toks"))


def token_frame(tokens: DataFrame, key="sample_id") -> DataFrame:
    """The tokens with the level of their scope (``_k``).  Depth, bracket scope,
    clause and 'SELECT seen' flags come along with the tokens: ``sql_tokens`` has
    carried them through the statement, so that its tokens need no windows here."""
    return tokens.withColumn("_k", F.col("cum"))


def _problem() -> Column:
    return (F.when(~F.col("first").isin(*VERBS), F.concat(F.lit("unknown statement start "), F.col("first")))
            .when((F.col("min_cum") < 0) | (F.col("final_cum") != 0), F.lit("unbalanced parentheses"))
            .when(F.col("quote_pos").isNotNull(), F.lit("unterminated quoted text"))
            .when(F.col("sf_pos").isNotNull(), F.lit("empty SELECT list"))
            .when(F.col("last").isin(*DANGLING), F.concat(F.lit("statement ends with "), F.col("last"))))


def _syntax_errors(g: DataFrame, key) -> DataFrame:
    return g.where(_problem().isNotNull()).select(
        key, F.lit(STAGE_SYNTAX).alias("stage"), F.lit(0).cast("bigint").alias("pos"),
        F.lit("syntax").alias("kind"), F.concat(F.lit(MSG_SYNTAX), _problem()).alias("message"))


def check_syntax(frame: DataFrame, key="sample_id") -> DataFrame:
    """V2: (sample_id, stage, pos, kind, message) for the first syntax problem found per rule."""
    return _syntax_errors(frame.where(F.col("syntax").isNotNull()).select(key, "syntax.*"), key)


def table_refs(frame: DataFrame, key="sample_id") -> DataFrame:
    """V3: (sample_id, pos, table_name, alias) — names lower-cased, quotes removed."""
    return frame.where(F.col("tref").isNotNull()).select(key, "pos", "tref.*")


def bound_names(frame: DataFrame, key="sample_id") -> DataFrame:
    """Names bound inside the statement: WITH names and derived-table aliases."""
    return frame.where("binds").select(key, F.col("name").alias("bound")).distinct()


def column_refs(frame: DataFrame, key="sample_id") -> DataFrame:
    """V4: (sample_id, pos, qualifier, column_name) for ``q.c`` and ``q.*``
    outside table references; ``db.t.c`` uses ``t`` as the qualifier."""
    return frame.where(F.col("cref").isNotNull()).select(key, "pos", "cref.*")


def _summarised(w: Rules) -> list:
    trefs, crefs, bound = (np.flatnonzero(x) for x in (w.is_tref, w.is_cref, w.is_cte | w.is_derived))
    return [pa.array(np.diff(w.offsets)), *(w.figures() | {"final_cum": w.highest_at_end()}).values(),
            w.lists(trefs, structs(pos=w.pos[trefs], **w.tref_fields(trefs))),
            w.lists(crefs, structs(pos=w.pos[crefs], **w.cref_fields(crefs))), w.lists(bound, w.names(bound))]


def statement_summary(samples: DataFrame, key="sample_id", sql="output", carry: bool = True) -> DataFrame:
    """One row per statement: its sample row (empty without ``carry``), whether it
    is blank, syntax figures, table references, resolved column references (J7)
    and bound names.  The arrays are bounded by the statement's own token count.

    Store it (``session.persist_once``) before using it twice: lexing and the
    windows are behind it."""
    row = F.struct(*[F.col(c) for c in (samples.columns if carry else [key])]).alias("_row")
    made = (f"n_tokens bigint, {_FIGURES}, trefs array<struct<pos:bigint,{_TREF}>>, "
            f"crefs array<struct<pos:bigint,{_CREF}>>, bound array<string>")
    g = statement_frame(samples.select(key, F.col(sql).alias("_sql"), row), made, _summarised, key, "_sql", keep=("_row",))
    g = g.withColumns({"trefs": F.sort_array("trefs"), "crefs": F.sort_array("crefs"), "bound": F.array_distinct("bound")})
    return fenced(g, key).withColumn("crefs", F.expr(_RESOLVED))


#: J7 inside a statement: the last alias (or bare table name) that a qualifier
#: is bound to, else the qualifier itself.
_RESOLVED = """
transform(crefs, c -> struct(
    c.pos as pos, c.qualifier as qualifier,
    coalesce(try_element_at(filter(trefs, t -> coalesce(t.alias, t.table_name) = c.qualifier), -1).table_name, c.qualifier) as table_name,
    c.column_name as column_name))
"""


def resolve_aliases(summary: DataFrame, key="sample_id") -> DataFrame:
    """(sample_id, pos, qualifier, table_name, column_name) of every column reference."""
    return summary.select(key, F.inline("crefs"))


def _references(summary: DataFrame, strict: bool, key, db) -> DataFrame:
    """(key, db, stage, pos, table_name, column_name) of all references to the catalog."""
    free = "true" if strict else "not array_contains(bound, r.table_name)"
    refs = F.expr(f"""filter(concat(
        transform(trefs, t -> struct({STAGE_TABLE} as stage, t.pos as pos, t.table_name as table_name, cast(null as string) as column_name)),
        transform(crefs, c -> struct({STAGE_COLUMN} as stage, c.pos as pos, c.table_name as table_name, c.column_name as column_name))),
        r -> {free})""")
    return summary.select(key, F.col(f"_row.{db}").alias(db), F.inline(refs))


def missing_references(summary: DataFrame, catalog_columns: DataFrame, strict: bool = False, key="sample_id",
                       db="db_id") -> DataFrame:
    """(sample_id, stage, pos, kind, message) of tables and columns that
    the sample's database lacks ('*' needs its table only).

    Only distinct names meet the catalog; the few that are missing join back."""
    cols = catalog_columns.select(db, F.lower("table_name").alias("table_name"), F.lower("column_name").alias("column_name")).distinct()
    tables = cols.select(db, "table_name").distinct().withColumn("_t", F.lit(True))
    refs = _references(summary, strict, key, db)
    names = refs.select(db, "table_name", "column_name").distinct()
    kind = (F.when(F.col("_t").isNull(), F.lit("missing_table"))
            .when(F.col("column_name").isNotNull() & (F.col("column_name") != "*") & F.col("_c").isNull(), F.lit("missing_column")))
    known = (names.join(tables, [db, "table_name"], "left")
             .join(cols.withColumn("_c", F.lit(True)), [db, "table_name", "column_name"], "left").withColumn("kind", kind))
    bad = known.where(F.col("kind").isNotNull()).select(
        F.col(db).alias("_db"), F.col("table_name").alias("_table"), F.col("column_name").alias("_column"), "kind")
    same = (refs[db].eqNullSafe(bad["_db"]) & (refs["table_name"] == bad["_table"]) & refs["column_name"].eqNullSafe(bad["_column"]))
    message = F.when(F.col("kind") == "missing_table", _msg(MSG_TABLE, t=F.col("table_name"))).otherwise(
        _msg(MSG_COLUMN, t=F.col("table_name"), c=F.col("column_name")))
    return refs.join(bad, same).select(key, "stage", "pos", "kind", message.alias("message"))


def _own_error() -> Column:
    """The error a statement has without the catalog (blank, no statement, syntax), or NULL."""
    text = F.when(F.col("n_tokens") == 0, F.lit("no SQL statement")).otherwise(_problem())
    return (F.when(F.col("blank"), F.struct(F.lit("blank").alias("kind"), F.lit("empty SQL").alias("message")))
            .when(text.isNotNull(), F.struct(F.lit("syntax").alias("kind"), F.concat(F.lit(MSG_SYNTAX), text).alias("message"))))


def validate_samples(samples: DataFrame, catalog_columns: DataFrame, strict: bool = False,
                     key="sample_id", db="db_id", sql="output", summary: DataFrame | None = None,
                     executed: DataFrame | None = None, rules=()) -> DataFrame:
    """V9: every sample with its verdict — the first error by (stage, position).

    ``summary``: the stored :func:`statement_summary` of ``samples`` (computed
    here per use when left out).  ``executed``: (key, exec_ok, error) of probe
    runs; a failed run of a SELECT is an error of the last stage (V8), other
    statements pass.  ``rules``: functions from the summary to further errors
    (key, stage, pos, kind, message)."""
    summary = statement_summary(samples, key, sql) if summary is None else summary
    errs = missing_references(summary, catalog_columns, strict, key, db)
    for rule in rules:
        errs = errs.unionByName(rule(summary))
    if executed is not None:
        failed = executed.where(~F.col("exec_ok")).select(F.col(key).alias("_key"), F.col("error").alias("_error"))
        select_only = summary.where(F.col("first") == "SELECT").join(failed, F.col(key) == F.col("_key"))
        errs = errs.unionByName(select_only.select(
            key, F.lit(STAGE_EXECUTION).alias("stage"), F.lit(0).cast("bigint").alias("pos"), F.lit("execution").alias("kind"),
            F.concat(F.lit(MSG_EXECUTION), F.coalesce("_error", F.lit(""))).alias("message")))
    first = errs.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct("kind", "message"), F.struct("stage", "pos", "kind")).alias("_e"))
    j = summary.join(first, F.col(key) == F.col("_key"), "left").withColumn("e", F.coalesce(_own_error(), F.col("_e")))
    return j.select("_row.*", F.col("e").isNull().alias("valid"), F.col("e.kind").alias("error_kind"), F.col("e.message").alias("error"))


def valid_samples(verdicts: DataFrame) -> DataFrame:
    return verdicts.where("valid").drop("valid", "error_kind", "error")


def validation_counts(verdicts: DataFrame, group=("db_id",)) -> DataFrame:
    """Samples per outcome ('valid' or the error kind)."""
    outcome = F.coalesce(F.col("error_kind"), F.lit("valid"))
    return verdicts.groupBy(*group, outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
