"""Column rules over SQL and model text: extraction, normalisation, gates.

All built-in expressions; the line-based rule of ``extract_sql`` works on the
split line array with higher-order functions, so whole texts are processed
inside the JVM without a Python round trip.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS_CLASS, collapse_ws, is_comment_token, is_keyword, py_strip, sql_lex

# fixed values: fence patterns.  Python's \s on str is the whitespace class;
# (?i) must also be Unicode-aware as in Python.
FENCE_SQL = r"(?isu)```sql" + WS_CLASS + r"*(.*?)" + WS_CLASS + r"*```"
FENCE_ANY = r"(?s)```" + WS_CLASS + r"*(.*?)" + WS_CLASS + r"*```"
# RE2 forms for the oracle (RE2's (?i) folds Unicode case already; it has no u flag).
FENCE_SQL_RE2 = r"(?is)```sql" + WS_CLASS + r"*(.*?)" + WS_CLASS + r"*```"
FENCE_ANY_RE2 = FENCE_ANY


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def extract_sql(col) -> Column:
    """SQL out of model text — first rule that matches wins.

    1. a ```sql fence (only if the lower-cased text contains ```sql);
    2. any ``` fence;
    3. from the first line whose stripped, upper-cased text starts with SELECT
       through the first following line ending in ';' (else to the end), each
       line stripped, joined by one space;
    4. the stripped text.
    """
    t = _c(col)
    has1 = F.lower(t).contains("```sql") & t.rlike(FENCE_SQL)
    r1 = py_strip(F.regexp_extract(t, FENCE_SQL, 1))
    has2 = t.contains("```") & t.rlike(FENCE_ANY)
    r2 = py_strip(F.regexp_extract(t, FENCE_ANY, 1))
    lines = F.transform(F.split(t, "\n", -1), lambda x: py_strip(x))
    # positions come from scanning the array itself, so the work is linear in the lines
    start = F.array_position(F.transform(lines, lambda x: F.upper(x).startswith("SELECT")), True)
    rest = F.slice(lines, F.greatest(start, F.lit(1)).cast("int"), F.size(lines))
    end = F.array_position(F.transform(rest, lambda x: x.endswith(";")), True).cast("int")
    r3 = F.array_join(F.when(end > 0, F.slice(rest, F.lit(1), end)).otherwise(rest), " ")
    return (F.when(has1, r1).when(has2, r2).when(start > 0, r3).otherwise(py_strip(t)))


def normalize_sql(col) -> Column:
    """Drop comments, lower-case keywords only (identifiers and quoted text
    keep their case), collapse every whitespace run to one space."""
    toks = sql_lex(_c(col))
    mapped = F.transform(toks, lambda x: F.when(is_comment_token(x), F.lit(" "))
                         .when(is_keyword(x), F.lower(x)).otherwise(x))
    return collapse_ws(F.array_join(mapped, ""))


def select_gate(col) -> Column:
    """only statements starting with SELECT (after strip, case-insensitive) may run."""
    return F.upper(py_strip(_c(col))).startswith("SELECT")


def limit_probe_sql(col) -> Column:
    """V8: the probe text the validator runs — SELECT only; when the text has no
    'LIMIT', drop one trailing ';' and append ' LIMIT 1'.  NULL = not probed."""
    t = py_strip(_c(col))
    no_semi = F.when(t.endswith(";"), F.left(t, F.length(t) - 1)).otherwise(t)
    probe = F.when(F.upper(t).contains("LIMIT"), t).otherwise(F.concat(no_semi, F.lit(" LIMIT 1")))
    return F.when(select_gate(t), probe)
