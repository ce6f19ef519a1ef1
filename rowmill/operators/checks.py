"""Data tests. A test is a Column that is true for a failing row; a null result is no failure.

Row tests of one table run in one scan and one aggregate, see ``run_tests``. Only uniqueness and
referential tests shuffle, after combining rows by key on the map side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowmill.functions.scalars import NUMERIC_TEXT, STAMP_TEXT
from rowmill.operators.skew import join_unique


def not_null(col: str) -> Column:
    return F.col(col).isNull()


def accepted(col: str, values: Sequence) -> Column:
    return ~F.col(col).isin(list(values))


def in_range(col: str, low=None, high=None) -> Column:
    out = F.lit(False)
    if low is not None:
        out = out | (F.col(col) < F.lit(low))
    if high is not None:
        out = out | (F.col(col) > F.lit(high))
    return out


def holds(expression: str) -> Column:
    return ~F.expr(expression)


def matches(col: str, pattern: str) -> Column:
    return ~F.regexp_like(F.col(col), F.lit(pattern))


def is_numeric(col: str) -> Column:
    return matches(col, NUMERIC_TEXT)


def is_valid_timestamp(col: str) -> Column:
    return matches(col, STAMP_TEXT)


def at_most(col: str, length: int) -> Column:
    return F.length(F.col(col)) > length


def failing_rows(df: DataFrame, test: Column) -> DataFrame:
    return df.filter(test)


def repeated_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Uniqueness test: each key held by more than one row, with its row count; nulls are no key."""
    return (df.dropna(how="any", subset=list(cols)).groupBy(*cols)
            .agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1))


def orphan_keys(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Referential test: each child key without a parent, with its row count."""
    keys = (child.filter(F.col(child_key).isNotNull()).groupBy(child_key)
            .agg(F.count(F.lit(1)).alias("n_rows")))
    known = parent.select(F.col(parent_key).alias("__parent")).distinct()
    return keys.join(known, keys[child_key] == known["__parent"], "left_anti")


def orphan_rows(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """The child rows behind ``orphan_keys``."""
    known = parent.select(F.col(parent_key).alias("__parent")).distinct()
    return join_unique(child.filter(F.col(child_key).isNotNull()), known, [child_key],
                       ["__parent"], "anti")


def run_tests(df: DataFrame, tests: Mapping[str, Column],
              counted: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``(test, failures, status)``: all row tests in one aggregate, then one row per key test.

    ``counted`` holds the failing keys of tests that need a shuffle of their own.
    """
    parts = []
    if tests:
        counts = df.agg(*[F.count_if(t).alias(f"t{i}") for i, t in enumerate(tests.values())])
        rows = F.array(*[F.struct(F.lit(n).alias("test"), F.col(f"t{i}").alias("failures"))
                         for i, n in enumerate(tests)])
        parts.append(counts.select(F.inline(rows)))
    for name, failing in (counted or {}).items():
        parts.append(failing.agg(F.count(F.lit(1)).alias("failures"))
                     .select(F.lit(name).alias("test"), "failures"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def assert_empty(df: DataFrame, name: str = "assertion") -> None:
    """Raise if the assertion query returns a row; at most one row reaches the driver."""
    found = df.take(1)
    if found:
        raise AssertionError(f"{name} failed, first row: {found[0].asDict()}")
