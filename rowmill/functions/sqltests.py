"""Data tests as table functions for SQL: ``SELECT t.*, failing FROM t, LATERAL is_numeric(t.c)``.

Each gives one row for one value, so a query with them stays one scan: Spark puts the function's expression in place of
the lateral join. A null value is no failure, as in ``operators.checks``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from rowmill.functions.scalars import NUMERIC_TEXT, STAMP_TEXT


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


# Name to parameters, and whether the value fails.
SQL_TESTS = {
    "is_numeric": ("value STRING", f"NOT regexp_like(value, '{_quoted(NUMERIC_TEXT)}')"),
    "is_valid_timestamp": ("value STRING", f"NOT regexp_like(value, '{_quoted(STAMP_TEXT)}')"),
    "accepted_values": ("value STRING, allowed ARRAY<STRING>", "NOT array_contains(allowed, value)"),
}


def register_tests(spark: SparkSession) -> None:
    """Make the tests known to the session's SQL."""
    for name, (parameters, fails) in SQL_TESTS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE (failing BOOLEAN) "
                  f"RETURN SELECT coalesce({fails}, false)")
