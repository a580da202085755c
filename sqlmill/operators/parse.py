"""Instruction / chat corpora → normalised (question, sql) pairs.

Every function is a pure DataFrame → DataFrame transform (no action inside).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_blank, py_strip

USER_ROLES = ("user", "human")
ASSISTANT_ROLES = ("assistant", "gpt")

TURN = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
# Union schema of both corpus formats; an explicit schema avoids an inference
# pass over the input and keeps optional keys from drifting.
CORPUS_SCHEMA = T.StructType([
    T.StructField("instruction", T.StringType()),
    T.StructField("input", T.StringType()),
    T.StructField("output", T.StringType()),
    T.StructField("conversations", T.ArrayType(TURN)),
])


def _str(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def alpaca_question(instruction="instruction", inp="input") -> Column:
    """``strip(instruction + "\\n" + input)`` if input is non-empty, else ``strip(instruction)``."""
    i, x = _str(instruction), _str(inp)
    return F.when(x != "", py_strip(F.concat(i, F.lit("\n"), x))).otherwise(py_strip(i))


def parse_alpaca(df: DataFrame, keys=("ord",)) -> DataFrame:
    """Every row kept; missing fields read as ''."""
    return df.select(*keys, alpaca_question().alias("question"), py_strip(_str("output")).alias("sql"))


def parse_sharegpt_long(turns: DataFrame, key="conv_id", turn="turn", role="role",
                        text="text") -> DataFrame:
    """N2 over the long form (one row per turn).

    Fewer than two turns (any role) → dropped.  The last user/human turn and the
    last assistant/gpt turn are taken, then stripped; a pair with either side
    blank is dropped.  ``max`` of a (turn, text) struct is a plain aggregate, so
    Spark combines it map-side before the shuffle on ``key``.
    """
    r = F.col(role)
    last_q = F.max(F.when(r.isin(*USER_ROLES), F.struct(F.col(turn).alias("t"), _str(text).alias("x"))))
    last_a = F.max(F.when(r.isin(*ASSISTANT_ROLES), F.struct(F.col(turn).alias("t"), _str(text).alias("x"))))
    g = turns.groupBy(key).agg(F.count(F.lit(1)).alias("n_turns"), last_q.alias("q"), last_a.alias("a"))
    q, a = py_strip(F.col("q.x")), py_strip(F.col("a.x"))
    return (g.where((F.col("n_turns") >= 2) & ~is_blank(q) & ~is_blank(a))
            .select(key, q.alias("question"), a.alias("sql")))


def _last_content(conv: Column, roles) -> Column:
    picked = F.filter(conv, lambda x: x["role"].isin(*roles))
    return F.try_element_at(picked, F.lit(-1))["content"]


def parse_sharegpt(df: DataFrame, keys=("ord",), conversations="conversations") -> DataFrame:
    """N2 over the nested form ``conversations: array<struct<role, content>>``."""
    conv = F.col(conversations)
    q = py_strip(_str(_last_content(conv, USER_ROLES)))
    a = py_strip(_str(_last_content(conv, ASSISTANT_ROLES)))
    ok = (F.coalesce(F.size(conv), F.lit(0)) >= 2) & ~is_blank(q) & ~is_blank(a)
    return df.where(ok).select(*keys, q.alias("question"), a.alias("sql"))


def nest_conversations(turns: DataFrame, key="conv_id") -> DataFrame:
    """Long form → one row per conversation with the ordered turn array.

    A conversation is a bounded group (one chat), so collecting it is safe.
    """
    g = turns.groupBy(key).agg(F.sort_array(F.collect_list(
        F.struct(F.col("turn"), F.col("role"), F.col("text").alias("content")))).alias("t"))
    return g.select(key, F.transform("t", lambda x: F.struct(x["role"].alias("role"),
                                                              x["content"].alias("content")))
                    .alias("conversations"))


def row_format() -> Column:
    """Per-row format — 'sharegpt' if it has conversations, else 'alpaca' if it
    has an instruction, else NULL (unrecognised)."""
    return (F.when(F.col("conversations").isNotNull(), F.lit("sharegpt"))
            .when(F.col("instruction").isNotNull(), F.lit("alpaca")))


def detect_format(df: DataFrame, group="dataset_id", order="ord") -> DataFrame:
    """Dataset-level format, decided by the first row in ``order``.

    ``min_by`` is an ordinary aggregate (partial + final), so no global sort and
    no group is gathered in one place.
    """
    first = F.min_by(F.struct(F.col("conversations").isNotNull().alias("c"),
                              F.col("instruction").isNotNull().alias("i")), F.col(order))
    g = df.groupBy(group).agg(first.alias("f"))
    fmt = (F.when(F.col("f.c"), F.lit("sharegpt")).when(F.col("f.i"), F.lit("alpaca"))
           .otherwise(F.lit("unknown")))
    return g.select(group, fmt.alias("format"))


def parse_any(df: DataFrame, keys=("ord",)) -> DataFrame:
    """Row-level dispatch (S5): each row parsed by its own format; unrecognised rows dropped."""
    fmt = row_format()
    conv = F.col("conversations")
    sq = py_strip(_str(_last_content(conv, USER_ROLES)))
    sa = py_strip(_str(_last_content(conv, ASSISTANT_ROLES)))
    s_ok = (F.coalesce(F.size(conv), F.lit(0)) >= 2) & ~is_blank(sq) & ~is_blank(sa)
    out = df.select(*keys, fmt.alias("format"),
                    F.when(fmt == "sharegpt", sq).otherwise(alpaca_question()).alias("question"),
                    F.when(fmt == "sharegpt", sa).otherwise(py_strip(_str("output"))).alias("sql"),
                    F.when(fmt == "sharegpt", s_ok).otherwise(F.lit(True)).alias("_ok"))
    return out.where(F.col("format").isNotNull() & F.col("_ok")).drop("_ok")


def bench_view(df: DataFrame, keys=("ord",)) -> DataFrame:
    """Benchmark row view.  Alpaca: ``strip(instruction + ' ' + input)`` / output;
    ShareGPT: first turn's content / last turn's content when there is more than one turn."""
    fmt = row_format()
    conv = F.col("conversations")
    n = F.coalesce(F.size(conv), F.lit(0))
    a_q = py_strip(F.concat(_str("instruction"), F.lit(" "), _str("input")))
    s_q = F.when(n > 0, _str(F.try_element_at(conv, F.lit(1))["content"])).otherwise(F.lit(""))
    s_r = F.when(n > 1, _str(F.try_element_at(conv, F.lit(-1))["content"])).otherwise(F.lit(""))
    return df.where(fmt.isNotNull()).select(
        *keys, fmt.alias("format"),
        F.when(fmt == "alpaca", a_q).otherwise(py_strip(s_q)).alias("question"),
        F.when(fmt == "alpaca", py_strip(_str("output"))).otherwise(py_strip(s_r)).alias("reference"))
