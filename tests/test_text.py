"""Text primitives against Python's own str/re behaviour (hand-picked edge rows)."""
import re

from pyspark.sql import functions as F

from conftest import one_col
from sqlmill.functions.sqltext import extract_sql, limit_probe_sql, normalize_sql, select_gate
from sqlmill.functions.text import PY_WHITESPACE, collapse_ws, py_strip, sql_lex, token_set

STRIP_ROWS = ["　 abc  ", "\x1cabc\x85", " x ", "  ", "", "a b", "\t\n\x0b\x0c\r z  "]


def test_whitespace_set_is_pythons():
    assert sorted(PY_WHITESPACE) == sorted(chr(c) for c in range(0x110000) if chr(c).isspace())


def test_py_strip_matches_python(spark):
    assert one_col(spark, STRIP_ROWS, py_strip("v")) == [s.strip() for s in STRIP_ROWS]


def test_collapse_matches_split_join(spark):
    rows = ["a 　 b\n\nc", "  x  ", "\x1c"]
    assert one_col(spark, rows, collapse_ws("v")) == [" ".join(s.split()) for s in rows]


TOKEN_ROWS = ["Café naïve façade", "école", "数据库 查询 SELECT", "x² y³ _id", "Ünïcödé_1 ß"]


def test_token_set_matches_python_word_class(spark):
    got = one_col(spark, TOKEN_ROWS, token_set("v"))
    for s, g in zip(TOKEN_ROWS, got):
        want = set(re.findall(r"\w+", s.lower()))
        # combining marks: Python's \w excludes U+0301, so does [\p{L}\p{N}_]
        assert set(g) == want, s


# hand-written expectations for the extraction rules
EXTRACT_CASES = [
    ("Sure.\n```SQL\n SELECT 1 \n```\ndone", "SELECT 1"),
    ("```mysql\nSELECT 2\n```", "mysql\nSELECT 2"),
    ("```sqlite\nSELECT 3\n```", "ite\nSELECT 3"),
    ("```sql\n```", ""),
    ("```sql\nSELECT unclosed 4", "SELECT unclosed 4"),
    ("Answer:\n  select a\n  from t;\nbecause x", "select a from t;"),
    ("SELECT a\nFROM t\ntrailing prose", "SELECT a FROM t trailing prose"),
    ("no sql here  ", "no sql here"),
    ("```\nfirst\n``` and ```\nsecond\n```", "first"),
]


def test_extract_sql_rules(spark):
    got = one_col(spark, [c for c, _ in EXTRACT_CASES], extract_sql("v"))
    assert got == [w for _, w in EXTRACT_CASES]


def test_normalize_sql(spark):
    rows = ["SELECT  Name FROM Users -- note\nWHERE x = 'A  B'", "select /* c */ a\tfrom T;"]
    got = one_col(spark, rows, normalize_sql("v"))
    assert got == ["select Name from Users where x = 'A B'", "select a from T;"]
    # idempotent
    assert one_col(spark, got, normalize_sql("v")) == got


def test_lexer_survives_huge_literals(spark):
    big = "SELECT '" + "x" * 200_000 + "' FROM t"
    esc = "SELECT '" + "''" * 20_000 + "' FROM t"
    sizes = one_col(spark, [big, esc], F.size(sql_lex("v")))
    assert sizes == [7, 7]


def test_gate_and_probe(spark):
    rows = [" select a from t; ", "WITH x AS (SELECT 1) SELECT * FROM x", "SELECT a FROM t LIMIT 3;"]
    assert one_col(spark, rows, select_gate("v")) == [True, False, True]
    assert one_col(spark, rows, limit_probe_sql("v")) == ["select a from t LIMIT 1", None,
                                                          "SELECT a FROM t LIMIT 3;"]
