"""New versions of tables, written beside the old files in the table's own format.

A table, or a partition of it, moves to its new files by a change of its location in the catalogue.
Until then readers see the old version, and a lost executor or a failed write changes nothing. A whole
table moves at once, buckets and all; partitions move one by one, so a driver lost between two leaves some old and
some new (``snapshots`` holds partitioned tables that change in one step). Old files stay for readers under
way; the caller removes them when it likes.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameWriter, Row, SparkSession, functions as F


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def bucketing(spark: SparkSession, table: str) -> tuple[int, list[str], list[str]] | None:
    """Number of buckets, the columns they go by and those they are sorted by; None for a table without buckets."""
    said = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(
        "col_name IN ('Num Buckets', 'Bucket Columns', 'Sort Columns')").collect()}
    if "Num Buckets" not in said:
        return None
    return int(said["Num Buckets"]), *(re.findall("`([^`]+)`", said.get(n, "")) for n in ("Bucket Columns", "Sort Columns"))


def bucketed_writer(writer: DataFrameWriter, buckets: int, by: Sequence[str], sort: Sequence[str]) -> DataFrameWriter:
    cut = writer.bucketBy(buckets, *by)
    return cut.sortBy(*sort) if sort else cut


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return rows.first()["data_type"]


def table_format(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Provider'")
    return rows.first()["data_type"]


def _beside(location: str) -> str:
    """A folder next to the table's; the mark of an earlier version is cut from its last part only."""
    return f"{re.sub('__v_[0-9a-f]{32}$', '', location.rstrip('/'))}__v_{uuid.uuid4().hex}"


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def replace_table(df: DataFrame, table: str) -> str:
    """Make ``df`` the whole content of the table; returns the folder of the old version."""
    spark = df.sparkSession
    old, buckets = table_location(spark, table), bucketing(spark, table)
    new = _beside(old)
    writer = df.write.format(table_format(spark, table))
    if buckets is None:
        writer.save(new)
    else:  # files know their bucket only if they are written as a table's
        made = f"{table}__v_{uuid.uuid4().hex}"
        bucketed_writer(writer.option("path", new), *buckets).saveAsTable(made)
        spark.sql(f"DROP TABLE {made}")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{_quoted(new)}'")
    spark.catalog.refreshTable(table)
    return old


def in_partitions(df: DataFrame, columns: Sequence[str], partitions: Sequence[Row]) -> DataFrame:
    """Rows of the given partitions; the values are literals, so other partitions are not read."""
    if not partitions:
        return df.limit(0)

    def is_one_of(column: str) -> Column:
        values = {row[column] for row in partitions}
        found = F.col(f"`{column}`").isin([v for v in values if v is not None])
        return F.coalesce(found, F.lit(None in values))

    out = reduce(lambda rows, column: rows.filter(is_one_of(column)), columns, df)
    if len(columns) == 1:
        return out
    wanted = df.sparkSession.createDataFrame(list(partitions), df.select(*columns).schema)
    wanted = wanted.toDF(*[f"__{c}" for c in columns])
    same = reduce(lambda a, b: a & b, [out[c].eqNullSafe(wanted[f"__{c}"]) for c in columns])
    return out.join(F.broadcast(wanted), same, "left_semi")


def _spec(columns: Sequence[str], row: Row) -> str:
    def literal(value) -> str:
        quoted = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return "null" if value is None else f"'{quoted}'"

    return ", ".join(f"`{c}` = {literal(row[c])}" for c in columns)


def replace_partitions(df: DataFrame, table: str, columns: Sequence[str],
                       touched: Sequence[Row]) -> str:
    """Make ``df`` the content of the touched partitions, and leave all others as they are.

    Partitions are names in the catalogue, which the driver holds in any case; no rows reach it. A
    touched partition without rows is pointed at a folder that holds none. Rows for any other partition
    are an error, found before the first one moves.
    """
    spark = df.sparkSession
    new, kind = _beside(table_location(spark, table)), table_format(spark, table)
    df.write.partitionBy(*columns).format(kind).save(new)
    empty = f"{new}__empty"
    df.limit(0).drop(*columns).write.format(kind).save(empty)
    written = spark.read.schema(df.schema).format(kind).load(new)
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    made = {tuple(r[c] for c in columns): unquote(r["folder"]) for r in
            written.select(*columns, folder.alias("folder")).distinct().collect()}
    known = {tuple(row[c] for c in columns) for row in touched}
    if lost := made.keys() - known:
        raise ValueError(f"rows were written for partitions that were not read: {sorted(map(str, lost))[:5]}")
    for row in touched:
        spec, path = _spec(columns, row), made.get(tuple(row[c] for c in columns), empty)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec})")
        spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{_quoted(path)}'")
    spark.catalog.refreshTable(table)
    return new
