"""Partitioned tables with one commit point: a version is a list of partitions, a table's name shows one version.

Three catalogue entries stand behind a name ``t``. ``t_files`` holds the rows of all versions, partitioned by the
table's columns and by a mark that each write gives each partition it makes. ``t_versions`` lists for each
version the marks it consists of, one row a partition. ``t`` itself is a view of the files whose marks the
current version lists. A change writes the partitions it touches under new marks, then the new version's
list, and then replaces the view: that one statement is the commit. A run that stops before it, after
however many partitions, leaves all old rows in sight and nothing else; readers never see a mixture.

Earlier versions stay readable (``as_of``, ``roll_back``) until their partitions are dropped (``drop_unlisted``). The lists stay tables:
neither partitions nor rows reach the driver. One writer at a time is expected; a writer that finds another version
current than the one it read from gives up and changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MARK, ROWS, VERSION = "__mark", "__rows", "__version"
_PROPERTY = "rowmill.version"


@dataclass(frozen=True)
class Snapshot:
    """What a snapshot table's name stands for at one moment."""
    table: str
    version: str
    columns: tuple[str, ...]
    partitions: tuple[str, ...]

    @property
    def files(self) -> str:
        return f"{self.table}_files"

    @property
    def versions(self) -> str:
        return f"{self.table}_versions"


def snapshot(spark: SparkSession, table: str) -> Snapshot | None:
    """The current version of a snapshot table; None for any other table."""
    if not spark.catalog.tableExists(table) or spark.catalog.getTable(table).tableType != "VIEW":
        return None
    known = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if _PROPERTY not in known:
        return None
    columns = [c for c in spark.catalog.listColumns(f"{table}_files") if c.name != MARK]
    names = spark.table(table).columns
    return Snapshot(table, known[_PROPERTY], tuple(names), tuple(c.name for c in columns if c.isPartition))


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[f"`{c}`"].eqNullSafe(right[f"`{c}`"]) for c in columns])


def _listed(of: Snapshot, spark: SparkSession) -> DataFrame:
    return spark.table(of.versions).filter(F.col(VERSION) == of.version).drop(VERSION)


def _write(rows: DataFrame, of: Snapshot) -> DataFrame:
    """Add ``rows`` to the files under marks of their own; what was written: partition, mark and rows."""
    spark, run = rows.sparkSession, uuid.uuid4().hex
    place = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in of.partitions]), {"ignoreNullFields": "false"}))
    marked = rows.withColumn(MARK, F.concat(F.lit(f"{run}-"), place))
    marked.select(*[f"`{c}`" for c in spark.table(of.files).columns]).write.insertInto(of.files)
    made = spark.table(of.files).filter(F.col(MARK).startswith(run))
    return made.groupBy(*[f"`{c}`" for c in of.partitions], MARK).agg(F.count(F.lit(1)).alias(ROWS))


def _commit(spark: SparkSession, of: Snapshot, version: str) -> None:
    """Show ``version`` under the table's name: the one statement that readers can notice."""
    names = ", ".join(f"`{c}`" for c in of.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {of.table} TBLPROPERTIES ('{_PROPERTY}' = '{version}') AS SELECT {names} FROM {of.files} "
              f"WHERE `{MARK}` IN (SELECT `{MARK}` FROM {of.versions} WHERE `{VERSION}` = '{version}')")


def _publish(listed: DataFrame, of: Snapshot) -> str:
    """Write a version's list, then commit it unless another version has been committed since ``of`` was read."""
    spark, version = listed.sparkSession, uuid.uuid4().hex
    out = listed.withColumn(VERSION, F.lit(version))
    out.select(*[f"`{c}`" for c in spark.table(of.versions).columns]).write.insertInto(of.versions)
    now = snapshot(spark, of.table)
    if now is not None and now.version != of.version:
        raise RuntimeError(f"{of.table} moved from version {of.version} to {now.version} during a write")
    _commit(spark, of, version)
    return version


def create_snapshot_table(df: DataFrame, table: str, partition_by: Sequence[str], path: str | None = None, kind: str = "parquet") -> str:
    """Make ``df`` a snapshot table, its files and lists under ``path`` if one is given; returns the first version."""
    if not partition_by:
        raise ValueError("a snapshot table needs partition columns")
    spark = df.sparkSession
    of = Snapshot(table, "", tuple(df.columns), tuple(partition_by))
    part = [F.col(f"`{c}`") for c in partition_by]
    shape = df.withColumn(MARK, F.lit("")).limit(0)
    lists = df.select(*part, F.lit("").alias(MARK), F.lit(0).cast("long").alias(ROWS), F.lit("").alias(VERSION)).limit(0)
    for empty, name, by in ((shape, of.files, [*partition_by, MARK]), (lists, of.versions, [VERSION])):
        writer = empty.write.format(kind).partitionBy(*by)
        (writer.option("path", f"{path}/{name}") if path else writer).saveAsTable(name)
    return _publish(_write(df, of), of)


def change_snapshot(of: Snapshot, touched: DataFrame, change: Callable[[DataFrame], DataFrame]) -> str:
    """Replace the ``touched`` partitions (a frame of their values) by ``change`` of their rows; returns the new version.

    Only those partitions are read, through their marks, and only those are written. Rows that ``change`` puts in
    any other partition are an error, found before the commit. Without touched partitions the version stays.
    """
    spark = touched.sparkSession
    listed = _listed(of, spark)
    wanted = touched.select(*[F.col(f"`{c}`") for c in of.partitions]).distinct()
    if wanted.isEmpty():
        return of.version
    held = listed.join(wanted, _same(listed, wanted, of.partitions), "left_semi")
    files = spark.table(of.files)
    part = files.join(F.broadcast(held.select(MARK)), MARK, "left_semi").select(*[f"`{c}`" for c in of.columns])
    written = _write(change(part), of)
    lost = written.join(wanted, _same(written, wanted, of.partitions), "left_anti").select(*[f"`{c}`" for c in of.partitions]).head(5)
    if lost:
        raise ValueError(f"rows were written for partitions that were not read: {[tuple(r) for r in lost]}")
    rest = listed.join(wanted, _same(listed, wanted, of.partitions), "left_anti")
    return _publish(rest.unionByName(written), of)


def as_of(spark: SparkSession, table: str, version: str) -> DataFrame:
    """The rows of an earlier version."""
    of = snapshot(spark, table)
    marks = spark.table(of.versions).filter(F.col(VERSION) == version).select(MARK)
    return spark.table(of.files).join(F.broadcast(marks), MARK, "left_semi").select(*[f"`{c}`" for c in of.columns])


def roll_back(spark: SparkSession, table: str, version: str) -> None:
    """Show an earlier version again; the later ones stay listed."""
    of = snapshot(spark, table)
    if spark.table(of.versions).filter(F.col(VERSION) == version).isEmpty() and version != of.version:
        raise ValueError(f"{table} has no version {version}")
    _commit(spark, of, version)


def unlisted(spark: SparkSession, table: str, keep: Sequence[str] = ()) -> DataFrame:
    """(partition columns, mark) of the files that neither the current version nor one of ``keep`` lists: older ones, and those of
    writes that did not finish. Only partitions are read, not rows."""
    of = snapshot(spark, table)
    kept = spark.table(of.versions).filter(F.col(VERSION).isin(of.version, *keep)).select(MARK)
    every = spark.table(of.files).select(*[f"`{c}`" for c in of.partitions], MARK).distinct()
    return every.join(kept, MARK, "left_anti")
