"""The library from SQL alone: text operators, prompt templates and validation rules as SQL functions.

Every function has a SQL body, which the analyzer inlines: a call costs what the
expression costs, and no Python runs.  Functions are temporary (per session).
Names that are registered again replace what was there.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import PY_WHITESPACE, SQL_KEYWORDS, SQL_LEXER, WORD_RE, WS_CLASS

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _bodies() -> dict[str, tuple[str, str, str]]:
    """Function name -> (parameters, result type, body)."""
    keywords = ", ".join(map(quoted, SQL_KEYWORDS))
    return {
        "py_strip": ("t STRING", "STRING", f"trim(BOTH {quoted(PY_WHITESPACE)} FROM t)"),
        "normalize_sql": ("t STRING", "STRING", f"""py_strip(regexp_replace(array_join(transform(
            regexp_extract_all(t, {quoted(SQL_LEXER)}, 0),
            x -> CASE WHEN startswith(x, '--') OR startswith(x, '/*') THEN ' ' WHEN upper(x) IN ({keywords}) THEN lower(x) ELSE x END), ''),
            {quoted(WS_CLASS + '+')}, ' '))"""),
        "select_gate": ("t STRING", "BOOLEAN", "startswith(upper(py_strip(t)), 'SELECT')"),
        "limit_probe_sql": ("t STRING", "STRING", """CASE WHEN select_gate(t) THEN
            CASE WHEN contains(upper(py_strip(t)), 'LIMIT') THEN py_strip(t)
                 ELSE concat(CASE WHEN endswith(py_strip(t), ';') THEN left(py_strip(t), length(py_strip(t)) - 1) ELSE py_strip(t) END, ' LIMIT 1') END END"""),
        "token_set": ("t STRING", "ARRAY<STRING>", f"array_distinct(regexp_extract_all(lower(t), {quoted(WORD_RE)}, 0))"),
        "f1_of_sets": ("p ARRAY<STRING>, r ARRAY<STRING>", "DOUBLE", """CASE
            WHEN size(p) = 0 OR size(r) = 0 OR size(array_intersect(p, r)) = 0 THEN 0D
            ELSE 2D * (size(array_intersect(p, r)) / CAST(size(p) AS DOUBLE)) * (size(array_intersect(p, r)) / CAST(size(r) AS DOUBLE))
                 / (size(array_intersect(p, r)) / CAST(size(p) AS DOUBLE) + size(array_intersect(p, r)) / CAST(size(r) AS DOUBLE)) END"""),
        "token_f1": ("p STRING, r STRING", "DOUBLE", "f1_of_sets(token_set(p), token_set(r))"),
    }


FUNCTIONS = tuple(_bodies())


def _create(spark: SparkSession, name: str, parameters: str, result: str, body: str) -> None:
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a function name: {name}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")


def register_functions(spark: SparkSession) -> None:
    """Makes ``FUNCTIONS`` known to the session's SQL."""
    for name, (parameters, result, body) in _bodies().items():
        _create(spark, name, parameters, result, body)


def register_template(spark: SparkSession, name: str, template: str) -> list[str]:
    """A prompt template as a SQL function of its ``{fields}``, in order of their first
    place; a NULL field is empty text, ``{{`` and ``}}`` are braces.  Returns the fields."""
    fields: list[str] = []
    parts: list[str] = []
    for text, field in re.findall(r"((?:[^{}]|\{\{|\}\})+)|\{([A-Za-z_][A-Za-z0-9_]*)\}", template):
        if field:
            if field not in fields:
                fields.append(field)
            parts.append(f"coalesce({field}, '')")
        else:
            parts.append(quoted(text.replace("{{", "{").replace("}}", "}")))
    _create(spark, name, ", ".join(f"{f} STRING" for f in fields), "STRING", f"concat({', '.join(parts)})" if parts else "''")
    return fields


def register_rule(spark: SparkSession, name: str, condition: str, message: str) -> None:
    """A validation rule: ``name(sql)`` is ``message`` where ``condition``, SQL over ``sql``, holds, else NULL."""
    _create(spark, name, "sql STRING", "STRING", f"CASE WHEN {condition} THEN {quoted(message)} END")


def rule(name: str, sql: str = "output", stage: int = 9, key: str = "sample_id") -> Callable[[DataFrame], DataFrame]:
    """A registered rule for ``validate_samples(rules=…)``: an error of ``stage`` where it has a message."""
    def errors(summary: DataFrame) -> DataFrame:
        found = summary.select(key, F.expr(f"{name}(_row.{sql})").alias("message")).where(F.col("message").isNotNull())
        return found.select(key, F.lit(stage).alias("stage"), F.lit(0).cast("bigint").alias("pos"), F.lit(name).alias("kind"), "message")
    return errors
