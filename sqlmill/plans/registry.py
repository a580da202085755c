"""Registry of named queries and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the given tables (or data
Spark derives from them).  ``oracle`` is the equivalent DuckDB SQL, or ``None``
for operators that SQL cannot express (model calls, driver-submitted jobs).
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import (queries_catalog, queries_eval, queries_gen, queries_misc, queries_plan, queries_text,  # noqa: F401
                   queries_validate)
