"""Counts and ages: one aggregate each."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, functions as F


def flow_counts(links: Mapping[str, DataFrame]) -> DataFrame:
    """``(link, n_rows)``, one row per named link."""
    out = None
    for name, df in links.items():
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("link"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


def route_counts(tagged: DataFrame, route: str = "route") -> DataFrame:
    """Rows per route of a tagged frame, in one pass."""
    return tagged.groupBy(route).agg(F.count(F.lit(1)).alias("n_rows"))


def metered(df: DataFrame, link: str) -> tuple[DataFrame, Observation]:
    """The same rows, counted while some later action reads them; no extra job."""
    meter = Observation(link)
    return df.observe(meter, F.count(F.lit(1)).alias("n_rows")), meter


def error_summary(reject: DataFrame) -> DataFrame:
    return reject.groupBy("errorCode").agg(F.count(F.lit(1)).alias("n_rows"))


def freshness(df: DataFrame, loaded_at: str, as_of: datetime | Column, warn_hours: int = 24,
              error_hours: int = 72) -> DataFrame:
    """Newest load time, its age in whole hours, and pass, warn or error; no rows is an error."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    newest = F.col("newest")

    def older(hours: int) -> Column:
        return newest < F.col("as_of") - F.make_dt_interval(hours=F.lit(hours))

    return (df.agg(F.max(loaded_at).alias("newest")).withColumn("as_of", now)
            .select("newest",
                    F.timestamp_diff("HOUR", newest, F.col("as_of")).alias("age_hours"),
                    F.when(newest.isNull() | older(error_hours), "error")
                    .when(older(warn_hours), "warn").otherwise("pass").alias("status")))
