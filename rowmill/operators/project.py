"""Projections, filters and schema helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rowmill.functions.scalars import cut, empty_to_null, text_columns, typed


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def map_columns(df: DataFrame, outputs: Mapping[str, str | Column],
                variables: Mapping[str, str | Column] | None = None) -> DataFrame:
    """Output columns from expressions over the input and over named variables.

    Variables are added one after another, so a later one may use an earlier one. Expressions are
    Columns or SQL text; an expression that fails ends the run (ANSI mode).
    """
    for name, value in (variables or {}).items():
        df = df.withColumn(name, F.expr(value) if isinstance(value, str) else value)
    return df.select(*[(F.expr(e) if isinstance(e, str) else e).alias(name)
                       for name, e in outputs.items()])


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(cols))


def require_castable(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Keep rows in which every named column has a value of its type."""
    for name, kind in types.items():
        df = df.filter(F.col(name).try_cast(kind).isNotNull())
    return df


def trim_text(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Trim the given text columns, or all of them."""
    chosen = text_columns(df) if cols is None else list(cols)
    return df.withColumns({c: F.trim(F.col(c)) for c in chosen}) if chosen else df


def null_empty_text(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    chosen = text_columns(df) if cols is None else list(cols)
    return df.withColumns({c: empty_to_null(F.col(c)) for c in chosen}) if chosen else df


def cut_text(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    return df.withColumns({c: cut(F.col(c), n) for c, n in lengths.items()}) if lengths else df


def split_columns(df: DataFrame, col: str, sep: str, names: Sequence[str],
                  key: str | None = None) -> DataFrame:
    """Split one text column by position; a missing part is null. Rows without ``key`` drop out."""
    parts = {n: empty_to_null(F.split_part(F.col(col), F.lit(sep), F.lit(i)))
             for i, n in enumerate(names, start=1)}
    out = df.withColumns(parts).drop(*({col} - set(names)))
    return out.filter(F.col(key).isNotNull()) if key else out


def convert_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order, converted where they differ; a bad value becomes null."""
    kinds = dict(zip(df.columns, (f.dataType for f in df.schema.fields)))
    return df.select(*[
        (F.col(f.name) if kinds[f.name] == f.dataType
         else typed(F.col(f.name), f.dataType, (f.metadata or {}).get("pattern"))).alias(f.name)
        for f in schema.fields])


def empty_like(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def schema_only(df: DataFrame) -> DataFrame:
    return df.limit(0)


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A relation of literal rows, for the small constant tables of a plan."""
    return spark.createDataFrame(list(rows), schema)


def union_all(first: DataFrame, *rest: DataFrame) -> DataFrame:
    for other in rest:
        first = first.unionByName(other)
    return first


def schema_diff(before: T.StructType, after: T.StructType) -> dict[str, str]:
    """Column → added, dropped or changed, between a step's input and its output."""
    old = {f.name: (f.dataType, f.nullable) for f in before.fields}
    new = {f.name: (f.dataType, f.nullable) for f in after.fields}
    diff = {n: "added" for n in new if n not in old}
    diff.update({n: "dropped" for n in old if n not in new})
    diff.update({n: "changed" for n in old if n in new and old[n] != new[n]})
    return diff


def trace(df: DataFrame, cols: Sequence[str], condition: str | Column | None = None) -> DataFrame:
    """Chosen columns of the rows that meet a condition, to inspect a link."""
    rows = df if condition is None else df.filter(condition)
    return rows.select(*cols)
