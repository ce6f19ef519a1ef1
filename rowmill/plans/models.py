"""The same pipeline as layered models: staging, unique, transformed, validated, final, duplicates.

Each model is a view over the one before it, so Catalyst sees one plan per written table.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from rowmill.functions.scalars import band
from rowmill.operators.dedupe import uniq
from rowmill.operators.project import rename, require_castable, require_not_null, trim_text
from rowmill.sinks.tables import as_table, as_view

# Staging names of the source columns, and the types rows are validated against.
STAGED = {"ID": "employee_id", "NAME": "employee_name", "DEPT": "department", "SAL": "salary",
          "AGE": "age"}
REQUIRED = ("employee_name", "department", "salary", "age", "salary_range", "date_timestamp")
TYPES = {"employee_id": "string", "employee_name": "string", "department": "string",
         "salary": "int", "age": "string", "salary_range": "string", "date_timestamp": "string"}


def staging(raw: DataFrame) -> DataFrame:
    return trim_text(rename(raw.select(*STAGED), STAGED))


def split(staged: DataFrame, **skew) -> dict[str, DataFrame]:
    """Unique and duplicate rows by name, compared as written, the smallest id first."""
    return uniq(staged, ["employee_name"], ["employee_id"], **skew)


def transformed(unique: DataFrame, run_at: datetime) -> DataFrame:
    return unique.withColumns({"salary_range": band(F.col("salary").try_cast("int")),
                               "date_timestamp": F.lit(run_at).cast("string")})


def validated(rows: DataFrame) -> DataFrame:
    return require_castable(require_not_null(rows, REQUIRED), TYPES).select(*TYPES)


def build(raw: DataFrame, run_at: datetime, prefix: str,
          after: Callable[[DataFrame], object] | None = None, **skew) -> dict[str, DataFrame]:
    """Register the four views and write the two tables, all named with ``prefix``.

    ``after`` gets the finished final table, for one to upsert it elsewhere.
    """
    staged = as_view(staging(raw), f"{prefix}_staged")
    parts = split(staged, **skew)
    unique = as_view(parts["unique"], f"{prefix}_unique")
    banded = as_view(transformed(unique, run_at), f"{prefix}_transformed")
    checked = as_view(validated(banded), f"{prefix}_validated")
    return {"final": as_table(checked, f"{prefix}_final", after=after),
            "duplicates": as_table(parts["duplicate"], f"{prefix}_duplicates")}
