"""Writing tables: insert, update, upsert, views and models.

Parquet tables have no UPDATE or MERGE. The functions in the first half compute the new version of
a table as a DataFrame; the ``write_`` functions store it as in ``versions``, and of a partitioned
table they read and write only the partitions the change can alter. Two layouts help a table that changes
often: buckets by its key (``as_bucketed``), which spare the table its shuffle, and snapshots (``snapshots``),
whose partitions change in one step.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F

from rowmill.operators.compliance import ColumnRule, compliance
from rowmill.operators.skew import comparable, fits_in_memory, join_unique, same_key
from rowmill.sinks.snapshots import change_snapshot, snapshot
from rowmill.sinks.versions import (
    bucketed_writer, bucketing, in_partitions, partition_columns, replace_partitions, replace_table)

BATCH_ROWS = 10_000


def _need_keys(keys: Sequence[str]) -> None:
    if not keys:
        raise ValueError("an update needs key columns to match rows by")


def _per_key(source: DataFrame, keys: Sequence[str], order_by: Sequence[str],
             firsts: Sequence[str], lasts: Sequence[str]) -> DataFrame:
    """One row per key: the columns of its earliest row, then those of its latest, as structs.

    Repeated source rows take effect one after another in ``order_by`` order. Both sides are
    combined on the map side, so a hot key shuffles one row per task.
    """
    known = [c for c in order_by if isinstance(c, str)]
    rest = [c for c in comparable(source) if c not in known]
    place = F.struct(*[F.col(f"`{c}`") for c in [*known, *rest]])
    aggs = []
    for name, pick, cols in (("__first", F.min_by, firsts), ("__last", F.max_by, lasts)):
        if cols:
            aggs.append(pick(F.struct(*[F.col(f"`{c}`") for c in cols]), place).alias(name))
    keyed = source.groupBy(*[F.col(f"`{k}`").alias(f"__key_{k}") for k in keys])
    return keyed.agg(F.lit(True).alias("__hit"), *aggs)


def _split_null_keys(source: DataFrame, keys: Sequence[str], null_safe: bool
                     ) -> tuple[DataFrame, DataFrame | None]:
    """Rows that can match, and rows that cannot because a key is null."""
    if null_safe:
        return source, None
    whole = source.dropna(how="any", subset=list(keys))
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(f"`{key}`").isNull()
    return whole, source.filter(missing)


def with_masks(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    return list(df.columns) if columns is None else list(columns)


def updated(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (),
            updatable: Sequence[str] | None = None, null_safe: bool = False, **join) -> DataFrame:
    """The target with matching rows set from the source; source rows without a match are ignored.

    ``join`` options, here and below, are those of ``join_unique``: ``share``, ``rows``, ``fits``.
    """
    _need_keys(keys)
    cols = [c for c in with_masks(source, updatable) if c not in keys and c in target.columns]
    usable, _ = _split_null_keys(source, keys, null_safe)
    latest = _per_key(usable, keys, order_by, (), cols)
    joined = join_unique(target, latest, list(keys), [f"__key_{k}" for k in keys], "left",
                         null_safe, **join)
    return joined.select(*[
        (F.when(F.col("__hit"), F.col(f"__last.`{c}`")).otherwise(F.col(f"`{c}`")).alias(c)
         if c in cols else F.col(f"`{c}`")) for c in target.columns])


def upserted(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (),
             insertable: Sequence[str] | None = None, null_safe: bool = False, **join) -> DataFrame:
    """Replace on key: every source key's latest row, and the target rows no source key matches."""
    _need_keys(keys)
    cols = [c for c in with_masks(source, insertable) if c in target.columns]
    usable, unmatched = _split_null_keys(source, keys, null_safe)
    latest = _per_key(usable, keys, order_by, (), cols)
    kept = join_unique(target, latest.drop("__last"), list(keys), [f"__key_{k}" for k in keys],
                       "anti", null_safe, **join)
    out = as_target(kept, target).unionByName(as_target(latest.select("__last.*"), target))
    return out if unmatched is None else out.unionByName(as_target(unmatched, target, cols))


def inserted_or_updated(target: DataFrame, source: DataFrame, keys: Sequence[str],
                        order_by: Sequence[str] = (), on_duplicate: Sequence[str] = (),
                        insertable: Sequence[str] | None = None, null_safe: bool = False, **join
                        ) -> DataFrame:
    """Insert; on a key that exists set only the ``on_duplicate`` columns.

    Of a source key that repeats, the first row is inserted and the last sets those columns.
    """
    _need_keys(keys)
    cols = [c for c in with_masks(source, insertable) if c in target.columns]
    sets = [c for c in on_duplicate if c in source.columns and c not in keys]
    usable, unmatched = _split_null_keys(source, keys, null_safe)
    changed = updated(target, usable, keys, order_by, sets, null_safe, **join)
    # Of the target's keys one record a key and task is left, so a hot one does not weigh here.
    held = target.select(*[F.col(f"`{k}`").alias(f"__held_{k}") for k in keys]).distinct()
    per_key = _per_key(usable, keys, order_by, cols, sets)
    same = same_key([per_key[f"`__key_{k}`"] for k in keys], [held[f"`__held_{k}`"] for k in keys], null_safe)
    fresh = per_key.join(held, same, "left_anti")
    fresh = fresh.select(*[F.col(f"__last.`{c}`").alias(c) if c in sets
                           else F.col(f"__first.`{c}`").alias(c) for c in cols])
    out = changed.unionByName(as_target(fresh, target))
    return out if unmatched is None else out.unionByName(as_target(unmatched, target, cols))


def deleted(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False,
            **join) -> DataFrame:
    """The target without the rows a source key matches."""
    _need_keys(keys)
    return _matched(target, source, keys, null_safe, "anti", **join)


def _matched(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False,
             how: str = "semi", **join) -> DataFrame:
    """Target rows that some source key matches, or with ``anti`` that none does."""
    wanted = source.select(*[F.col(f"`{k}`").alias(f"__key_{k}") for k in keys]).distinct()
    return join_unique(target, wanted, list(keys), [f"__key_{k}" for k in keys], how, null_safe,
                       **join)


def as_target(df: DataFrame, target: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """The columns and types of the target; columns the rows lack or may not set are null."""
    have = set(df.columns if cols is None else cols)
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema.fields])


def with_added(df: DataFrame, add_cols: Mapping[str, Column] | None) -> DataFrame:
    return df.withColumns(dict(add_cols)) if add_cols else df


def split_for_write(df: DataFrame, rules: Sequence[ColumnRule]) -> dict[str, DataFrame]:
    """``{"written", "reject"}``: rows a sink could refuse are found before the write."""
    checked = compliance(df, rules, empty_is_null=False)
    return {"written": checked["pass"], "reject": checked["reject"]}


# --- writes -------------------------------------------------------------------------------------


def write_insert(df: DataFrame, table: str, add_cols: Mapping[str, Column] | None = None,
                 insertable: Sequence[str] | None = None,
                 max_records_per_file: int | None = None) -> None:
    """Append to a table that must exist, by column name; columns not insertable are null."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table does not exist: {table}")
    rows = with_added(df, add_cols)
    shaped = as_target(rows, spark.table(table), insertable)
    writer = shaped.write
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.insertInto(table)


def _touched(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str],
             change: Callable[..., DataFrame], **join) -> DataFrame:
    """Partitions with a row that a source key matches, and those that changed and new rows go to.

    ``change`` of the matching rows alone says where rows go; it needs the keys and these columns only.
    """
    narrow = target.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keys, *columns])])
    hit = _matched(narrow, source, keys, **join)
    places = [F.col(f"`{c}`") for c in columns]
    return hit.select(*places).unionByName(change(hit, **join).select(*places)).distinct()


def _write_version(df: DataFrame, table: str, keys: Sequence[str],
                   change: Callable[..., DataFrame], **join) -> str:
    """Apply ``change`` to the table, or to no more than the partitions it can alter.

    The source is measured first: one that fits in memory leaves the target unshuffled. So does a target
    with buckets by the keys: the source is then dealt out like the buckets.
    """
    _need_keys(keys)
    spark = df.sparkSession
    target, shown = spark.table(table), snapshot(spark, table)
    join = {"fits": fits_in_memory(df), **join}
    if shown is not None:
        touched = _touched(target, df, keys, shown.partitions, change, **join)
        return change_snapshot(shown, touched, lambda part: as_target(change(part, **join), target))
    columns = partition_columns(spark, table)
    if not columns:
        buckets = bucketing(spark, table)
        if buckets and buckets[1] == list(keys) and not join["fits"]:
            join["spread"] = buckets[0]
        return replace_table(as_target(change(target, **join), target), table)
    touched = _touched(target, df, keys, columns, change, **join).collect()
    part = in_partitions(target, columns, touched)
    return replace_partitions(as_target(change(part, **join), target), table, columns, touched)


def write_update(df: DataFrame, table: str, keys: Sequence[str], order_by: Sequence[str] = (),
                 add_cols: Mapping[str, Column] | None = None,
                 updatable: Sequence[str] | None = None, **options) -> str:
    """Update matching rows of a table; of a partitioned one only the partitions that hold any."""
    source = with_added(df, add_cols)

    def change(target: DataFrame, **join) -> DataFrame:
        return updated(target, source, keys, order_by, updatable, **join)

    return _write_version(source, table, keys, change, **options)


def write_upsert(df: DataFrame, table: str, keys: Sequence[str], order_by: Sequence[str] = (),
                 on_duplicate: Sequence[str] | None = None,
                 add_cols: Mapping[str, Column] | None = None,
                 insertable: Sequence[str] | None = None, **options) -> str:
    """Replace on key, or with ``on_duplicate`` insert and set only those columns on a match."""
    source = with_added(df, add_cols)

    def change(target: DataFrame, **join) -> DataFrame:
        if on_duplicate is None:
            return upserted(target, source, keys, order_by, insertable, **join)
        return inserted_or_updated(target, source, keys, order_by, on_duplicate, insertable, **join)

    return _write_version(source, table, keys, change, **options)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
               batch_rows: int = BATCH_ROWS, writers: int = 16) -> None:
    """Append to a database table in batches, over a bounded number of connections.

    The rows are handed to the writers by a shuffle, so the work before it keeps all its tasks.
    """
    (df.repartition(writers).write.option("batchsize", batch_rows)
     .jdbc(url, table, mode="append", properties=dict(properties or {})))


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_table(df: DataFrame, name: str, partition_by: Sequence[str] = (),
             after: Callable[[DataFrame], object] | None = None) -> DataFrame:
    """Write ``df`` as a table; ``after`` is called with the table once it is complete."""
    df.write.mode("overwrite").partitionBy(*partition_by).saveAsTable(name)
    table = df.sparkSession.table(name)
    if after is not None:
        after(table)
    return table


def as_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table in buckets by ``keys``, sorted within them.

    Upserts by these keys, and joins on them, then leave the table where it is and shuffle only the other side.
    Rows are dealt out by key first, so a bucket is one file.
    """
    _need_keys(keys)
    dealt = df.repartition(buckets, *[F.col(f"`{k}`") for k in keys])
    writer = bucketed_writer(dealt.write.mode("overwrite"), buckets, keys, keys)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def newer_than(df: DataFrame, target: DataFrame, since: str, lookback: Column | None = None) -> DataFrame:
    """Rows from the target's high-water mark on, or from ``lookback`` (a duration or number) before it,
    and rows without a time; all rows if the target has no mark."""
    mark = target.agg(F.max(since).alias("mark")).scalar()
    start = mark if lookback is None else mark - lookback
    return df.filter(mark.isNull() | F.col(since).isNull() | (F.col(since) >= start))


def not_older(df: DataFrame, target: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Rows that come after, or with, what the target holds for their key; a null comes before all."""
    held = target.groupBy(*[F.col(f"`{k}`").alias(f"__key_{k}") for k in keys]).agg(
        F.max(F.struct(*[F.col(f"`{c}`") for c in order_by])).alias("__held"))
    same = [F.col(f"`{k}`") == F.col(f"__key_{k}") for k in keys]
    place = F.struct(*[F.col(f"`{c}`") for c in order_by])
    return df.join(held, same, "left").filter(F.col("__held").isNull() | (place >= F.col("__held"))).select(*df.columns)


def beyond(df: DataFrame, held: DataFrame) -> DataFrame:
    """Rows of ``df`` that ``held``, of the same columns, lacks: nulls are equal, and copies count one by one."""
    both = df.withColumn("__n", F.lit(1)).unionByName(held.withColumn("__n", F.lit(-1)))
    more = both.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.sum("__n").alias("__n")).filter("__n > 0")
    return more.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))).drop("__n")


def unkeyed_table(table: str) -> str:
    """Where ``as_incremental`` puts rows without a key that it cannot place."""
    return f"{table}_unkeyed"


def split_unkeyed(df: DataFrame, table: str, keys: Sequence[str], since: str | None) -> DataFrame:
    """The rows of ``df`` with a null key that are to be added to ``table``; late ones go to its reject.

    Such a row replaces nothing. Those are new that neither the table nor its reject, ``unkeyed_table``, holds
    in all columns: past the table's mark, the greatest ``since``, they are returned; at it, behind it or without a time
    they are put in the reject, which is made when first needed. Copies within ``df`` count one by one, so
    what comes again must come whole.
    """
    spark = df.sparkSession
    target, reject = spark.table(table), unkeyed_table(table)
    missing = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
    held = target.filter(missing)
    if spark.catalog.tableExists(reject):
        held = held.unionByName(spark.table(reject))
    unkeyed = beyond(as_target(df.filter(missing), target), held)
    if since is None:
        return unkeyed
    mark = target.agg(F.max(f"`{since}`").alias("mark")).scalar()
    past = mark.isNull() | F.coalesce(F.col(f"`{since}`") > mark, F.lit(False))
    late = unkeyed.filter(~past)
    if not late.isEmpty():  # before the table, and with it the mark, moves
        late.write.mode("append").saveAsTable(reject)
    return unkeyed.filter(past)


def as_incremental(df: DataFrame, table: str, keys: Sequence[str], since: str, lookback: Column | None = None) -> DataFrame:
    """Create the table on the first run; later upsert the rows that are new to it.

    Rows at the mark, and with ``lookback`` some time before it, are taken again, which changes nothing:
    a row replaces what the table holds for its key only if it is not older. Rows with a null key are taken, whatever
    their time, as in ``split_unkeyed``.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return as_table(upserted(df.limit(0), df, keys, [since]), table)
    target = spark.table(table)
    unkeyed = split_unkeyed(df, table, keys, since)
    keyed = df.dropna(how="any", subset=list(keys))
    fresh = not_older(newer_than(keyed, target, since, lookback), target, keys, [since])
    write_upsert(as_target(fresh, target).unionByName(unkeyed), table, keys, [since])
    return spark.table(table)


def write_run(df: DataFrame, table: str, tags: Mapping[str, str]) -> None:
    """Put the rows of one run in a table, tagged, in place of what it holds of that run.

    A run repeated after a failure, or by mistake, leaves the table as one run does. Of a table
    partitioned by the tags only the run's partition is written, in one step; any other is rewritten if it
    holds rows of the run, else appended to. A table that does not exist is made with such partitions.
    """
    spark, names = df.sparkSession, list(tags)
    tagged = df.withColumns({c: F.lit(v) for c, v in tags.items()})
    if not spark.catalog.tableExists(table):
        tagged.write.partitionBy(*names).saveAsTable(table)
        return
    target = spark.table(table)
    shaped = as_target(tagged, target)
    if partition_columns(spark, table) == names:
        run = [Row(**{c: tags[c] for c in names})]
        replace_partitions(shaped, table, names, run)
        return
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`") == v for c, v in tags.items()])
    if target.filter(same).isEmpty():
        shaped.write.insertInto(table)
    else:
        replace_table(target.filter(~F.coalesce(same, F.lit(False))).unionByName(shaped), table)


def quarantine(reject: DataFrame, table: str, source: str, run: str) -> None:
    """Add rejected rows to an error table, tagged with where and when they failed; a run counts once."""
    write_run(reject, table, {"source": source, "run": run})
