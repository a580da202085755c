"""sqlmill: a Spark-native engine for building and scoring text-to-SQL data.

Operators are DataFrame -> DataFrame functions under ``sqlmill.operators``;
named queries (with DuckDB oracle SQL) live in ``sqlmill.plans``.
"""

__version__ = "0.1.0"
