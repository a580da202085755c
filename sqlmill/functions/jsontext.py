"""JSON out of model text (N10) as Column expressions.

Rules, first that applies wins:
1. the whole text parses as JSON;
2. a ```json fence with a closing fence: its stripped body must parse, else error;
3. any ``` fence with a closing fence: same;
4. from the first '{' or '[' (whichever comes first) to the last '}' or ']'
   respectively: must parse, else error;
5. otherwise: error.

The result is ``struct<json: string, error: string>`` — the JSON text, ready
for ``from_json`` with the caller's schema, or the reason it was rejected.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import py_strip

E_FENCE = "invalid JSON in fence"
E_BRACES = "invalid JSON between brackets"
E_NONE = "no JSON found"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_json(col) -> Column:
    """Exactly one JSON value, as Python's parser accepts it.

    Spark's parser stops after the first value and ignores what follows, so the
    text must also be the only element of a one-element array, and a field that
    follows it inside an object must be found.  A key may occur twice (the last
    value counts)."""
    c = _c(col)
    one = F.json_array_length(F.concat(F.lit("["), c, F.lit("]"))) == 1
    framed = F.from_json(F.concat(F.lit('{"v":'), c, F.lit(',"end":0}')), "end int",
                         {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"})
    return F.coalesce(one & (framed["end"] == 0), F.lit(False))


def _fence_body(t: Column, marker: str) -> tuple[Column, Column]:
    """(found, stripped body) of the first ``marker`` fence closed by ```."""
    p = F.instr(t, marker)
    start = p + len(marker)
    rest = F.substr(t, start, F.length(t) + 1)
    rel = F.instr(rest, "```")
    found = (p > 0) & (rel > 0)
    return found, py_strip(F.substr(t, start, rel - 1))


def _last(t: Column, ch: str) -> Column:
    """1-based position of the last ``ch`` (0 if absent)."""
    r = F.instr(F.reverse(t), ch)
    return F.when(r > 0, F.length(t) - r + 1).otherwise(0)


def with_extracted_json(df, text: str, out: str = "x"):
    """Adds ``out`` = struct<json, error>; each intermediate (positions, candidate
    bodies, one parse check each) is computed once in its own projection."""
    t = F.col(text)
    p1 = F.instr(t, "```json")
    p2 = F.instr(t, "```")
    d = df.withColumns({
        "_p1": p1, "_r1": F.instr(F.substr(t, p1 + 7, F.length(t) + 1), "```"),
        "_p2": p2, "_r2": F.instr(F.substr(t, p2 + 3, F.length(t) + 1), "```"),
        "_ob": F.instr(t, "{"), "_ok": F.instr(t, "["),
        "_cb": F.instr(F.reverse(t), "}"), "_ck": F.instr(F.reverse(t), "]"),
    })
    ob, ok = F.col("_ob"), F.col("_ok")
    brace_first = (ob > 0) & ((ok == 0) | (ob < ok))
    cr = F.when(brace_first, F.col("_cb")).otherwise(F.col("_ck"))
    close = F.when(cr > 0, F.length(t) - cr + 1).otherwise(0)
    open_ = F.when(brace_first, ob).otherwise(ok)
    d = d.withColumns({
        "_f1": (F.col("_p1") > 0) & (F.col("_r1") > 0),
        "_b1": py_strip(F.substr(t, F.col("_p1") + 7, F.col("_r1") - 1)),
        "_f2": (F.col("_p2") > 0) & (F.col("_r2") > 0),
        "_b2": py_strip(F.substr(t, F.col("_p2") + 3, F.col("_r2") - 1)),
        "_hs": ((ob > 0) | (ok > 0)) & (close > 0),
        "_sp": F.substr(t, open_, close - open_ + 1),
    })
    d = d.withColumns({"_j0": is_json(t), "_j1": is_json("_b1"), "_j2": is_json("_b2"), "_js": is_json("_sp")})
    c = F.col
    js = (F.when(c("_j0"), t).when(c("_f1"), F.when(c("_j1"), c("_b1")))
          .when(c("_f2"), F.when(c("_j2"), c("_b2"))).when(c("_hs"), F.when(c("_js"), c("_sp"))))
    err = (F.when(c("_j0"), F.lit(None)).when(c("_f1"), F.when(~c("_j1"), F.lit(E_FENCE)))
           .when(c("_f2"), F.when(~c("_j2"), F.lit(E_FENCE))).when(c("_hs"), F.when(~c("_js"), F.lit(E_BRACES)))
           .otherwise(F.lit(E_NONE)))
    tmp = ["_p1", "_r1", "_p2", "_r2", "_ob", "_ok", "_cb", "_ck", "_f1", "_b1", "_f2", "_b2", "_hs", "_sp",
           "_j0", "_j1", "_j2", "_js"]
    return d.withColumn(out, F.struct(js.alias("json"), err.cast("string").alias("error"))).drop(*tmp)
