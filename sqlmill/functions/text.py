"""Column-level text primitives shared by every operator.

All of these are built-in Spark expressions (JVM side, inside whole-stage
codegen); none of them calls Python per row.  The regular expressions are
written so that the same pattern text is accepted by Java's regex engine and
by RE2 (used by the DuckDB oracle), except the SQL lexer, whose Java form uses
possessive quantifiers (see ``SQL_LEXER``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Python's str.strip()/str.split() whitespace: the 29 code points for which
# str.isspace() is true.  Spark's plain trim() only removes U+0020.
PY_WHITESPACE_CODEPOINTS = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0,
    0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007,
    0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
PY_WHITESPACE = "".join(chr(c) for c in PY_WHITESPACE_CODEPOINTS)
# The same set as a regex character class (Java and RE2 both read \x{..}).
WS_CLASS = (r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
# Python's \w on str: letters, numbers and underscore.
WORD_RE = r"[\p{L}\p{N}_]+"

# Keywords lower-cased by SQL normalisation and excluded from identifiers in
# the validator.  One list for Spark and for the oracle SQL.
SQL_KEYWORDS = (
    "ADD ALL ALTER AND ANY AS ASC AVG BETWEEN BY CASE CAST COUNT CREATE CROSS "
    "DELETE DESC DISTINCT DROP ELSE END EXCEPT EXISTS FALSE FROM FULL GROUP "
    "HAVING IF IN INNER INSERT INTERSECT INTERVAL INTO IS JOIN LEFT LIKE LIMIT "
    "MAX MIN NATURAL NOT NULL OFFSET ON OR ORDER OUTER OVER PARTITION REGEXP "
    "RIGHT RLIKE SELECT SET SUM TABLE THEN TRUE UNION UPDATE USING VALUES WHEN "
    "WHERE WITH"
).split()
# --- end of fixed values ----------------------------------------------------

# SQL lexer: string literal, "quoted", `quoted`, line comment, block comment,
# word, whitespace run, any other single character.  The Java form uses
# possessive quantifiers: the backtracking form overflows the JVM thread stack
# on long literals and kills the executor.  RE2 has no backtracking stack and
# no possessive syntax, so the oracle uses the plain form.
# Words and whitespace come first (the common cases); no two alternatives can
# start with the same character except the single-character fallback, which
# is last, so the order does not change the tokens.
SQL_LEXER = (
    r"[\p{L}\p{N}_]++"
    r"|" + WS_CLASS + r"++"
    r"|'(?:[^'\\]++|''|\\[\s\S])*+'"
    r'|"(?:[^"\\]++|""|\\[\s\S])*+"'
    r"|`[^`]*+`"
    r"|--[^\n]*+"
    r"|/\*[\s\S]*?\*/"
    r"|[\s\S]"
)
SQL_LEXER_RE2 = (
    r"[\p{L}\p{N}_]+"
    r"|" + WS_CLASS + r"+"
    r"|'(?:[^'\\]|''|\\[\s\S])*'"
    r'|"(?:[^"\\]|""|\\[\s\S])*"'
    r"|`[^`]*`"
    r"|--[^\n]*"
    r"|/\*[\s\S]*?\*/"
    r"|[\s\S]"
)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """Python ``str.strip()``: remove all Unicode whitespace at both ends."""
    return F.trim(_c(col), F.lit(PY_WHITESPACE))


def is_blank(col) -> Column:
    """True when the text is NULL or only whitespace (Python: ``not s.strip()``)."""
    return F.coalesce(py_strip(col) == F.lit(""), F.lit(True))


def collapse_ws(col) -> Column:
    """Python ``' '.join(s.split())``."""
    return py_strip(F.regexp_replace(_c(col), WS_CLASS + "+", " "))


def token_set(col) -> Column:
    """Distinct lower-cased word tokens (Python ``set(re.findall(r'\\w+', s.lower()))``)."""
    return F.array_distinct(F.regexp_extract_all(F.lower(_c(col)), F.lit(WORD_RE), 0))


def sql_lex(col) -> Column:
    """All lexer tokens of a SQL text, in order, whitespace and comments included."""
    return F.regexp_extract_all(_c(col), F.lit(SQL_LEXER), 0)


def sql_pieces(col) -> Column:
    """``sql_lex`` of a stripped text, each run of whitespace being the end of the
    token before it: half as many elements."""
    return F.regexp_extract_all(_c(col), F.lit(f"(?:{SQL_LEXER}){WS_CLASS}*+"), 0)


def is_comment_token(t: Column) -> Column:
    return t.startswith("--") | t.startswith("/*")


def is_keyword(t: Column) -> Column:
    return F.upper(t).isin(*SQL_KEYWORDS)
