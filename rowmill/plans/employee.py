"""The whole flow: read, split unique from duplicate, derive, check, update one table, insert one.

``flow`` composes lazily and returns every link. ``run`` writes: it stores the tagged rows once in
the shared folder, so the shuffle of the split is not repeated for its two sinks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowmill.functions.scalars import band, stamp
from rowmill.operators.compliance import ColumnRule, compliance, tag_compliance
from rowmill.operators.dedupe import tag_duplicates, uniq
from rowmill.operators.project import map_columns
from rowmill.session import scratch_path
from rowmill.sinks.tables import quarantine, write_insert, write_run, write_update

COLUMNS = ("ID", "NAME", "DEPT", "SAL", "AGE")
# The checked columns. Only ID may be null; the stamp has no length check.
RULES = (
    ColumnRule("ID", "string", nullable=True),
    ColumnRule("NAME", "string", nullable=False),
    ColumnRule("DEPT", "string", nullable=False),
    ColumnRule("SAL", "int", nullable=False),
    ColumnRule("AGE", "string", nullable=False),
    ColumnRule("SAL_RANGE", "string", nullable=False),
    ColumnRule("DATE_TIMESTAMP", "string", nullable=False),
)
KEYS = ("NAME",)
CASE = {"NAME": False}


def enrich(unique: DataFrame, run_at: datetime | Column, keep: Sequence[str] = ()) -> DataFrame:
    """The map step: the columns as they come, the salary band and the run's stamp."""
    moment = run_at if isinstance(run_at, Column) else F.lit(run_at)
    return map_columns(
        unique,
        {**{c: F.col(c) for c in COLUMNS}, "SAL_RANGE": F.col("sal_band"),
         "DATE_TIMESTAMP": F.col("run_stamp"), **{c: F.col(c) for c in keep}},
        variables={"sal_band": band(F.col("SAL")), "run_stamp": stamp(moment)})


def _links(unique: DataFrame, duplicate: DataFrame, run_at: datetime | Column
           ) -> dict[str, DataFrame]:
    mapped = enrich(unique, run_at)
    checked = compliance(mapped, RULES)
    return {"unique": unique, "duplicate": duplicate, "mapped": mapped,
            "pass": checked["pass"], "reject": checked["reject"]}


def flow(rows: DataFrame, run_at: datetime | Column, order_by: Sequence[str | Column] = ("ID",),
         **skew) -> dict[str, DataFrame]:
    """Every link as a plan of its own, none dearer than it has to be alone."""
    parts = uniq(rows, list(KEYS), order_by, CASE, **skew)
    return _links(parts["unique"], parts["duplicate"], run_at)


def link_counts(rows: DataFrame, run_at: datetime | Column,
                order_by: Sequence[str | Column] = ("ID",), **skew) -> DataFrame:
    """Rows per link, all from one pass over the tagged and checked rows."""
    tagged = tag_duplicates(rows, list(KEYS), order_by, CASE, "route", **skew)
    checked = tag_compliance(enrich(tagged, run_at, keep=("route",)), RULES)
    first, clean = F.col("route") == "unique", F.col("errorCode").isNull()
    counts = checked.agg(*[F.count_if(test).alias(link) for link, test in (
        ("unique", first), ("duplicate", ~first), ("mapped", first), ("pass", first & clean),
        ("reject", first & ~clean))])
    pairs = F.array(*[F.struct(F.lit(c).alias("link"), F.col(c).alias("n_rows"))
                      for c in counts.columns])
    return counts.select(F.inline(pairs))


def run(spark: SparkSession, rows: DataFrame, run_at: datetime, clean_table: str,
        duplicate_table: str, reject_table: str, update_keys: Sequence[str],
        order_by: Sequence[str | Column] = ("ID",), **skew) -> Mapping[str, str]:
    """Write all three tables; the stored split is cut by route, so each sink reads its part only.

    A run repeated with one ``run_at`` leaves the reject table, and a duplicate table that has a column ``run``, as one run
    does; a duplicate table without it cannot tell runs apart and gets the rows again.
    """
    path = scratch_path(spark, "split")
    tagged = tag_duplicates(rows, list(KEYS), order_by, CASE, "route", **skew)
    tagged.write.partitionBy("route").parquet(path)
    stored = spark.read.schema(tagged.schema).parquet(path)
    unique = stored.filter(F.col("route") == "unique").drop("route")
    duplicate = stored.filter(F.col("route") == "duplicate").drop("route")
    out = _links(unique, duplicate, run_at)
    if "run" in spark.table(duplicate_table).columns:
        write_run(duplicate, duplicate_table, {"run": run_at.isoformat()})
    else:
        write_insert(duplicate, duplicate_table)
    quarantine(out["reject"], reject_table, clean_table, run_at.isoformat())
    replaced = write_update(out["pass"], clean_table, update_keys)
    return {"split": path, "replaced": replaced}
