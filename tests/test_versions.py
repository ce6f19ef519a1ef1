"""Snapshot tables, bucketed tables, runs that repeat and the hot-key sketch."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rowmill.operators.skew import hot_hashes, sketch_cells
from rowmill.plans import employee
from rowmill.sinks import snapshots as S, tables as W
from rowmill.streaming.incremental import load_new

ROWS = [(1, "a", "p1", 1), (2, "b", "p2", 1), (3, "c", "p3", 2), (4, "d", None, 2), (5, "e", "p1", 2)]
SCHEMA = "id int, v string, p string, q int"


def made(spark, name):
    S.create_snapshot_table(spark.createDataFrame(ROWS, SCHEMA), name, ["p", "q"])
    return name


def change(spark, *changed):
    return spark.createDataFrame(list(changed), "id int, v string")


def test_a_snapshot_table_reads_and_changes_like_any_other(spark):
    name = made(spark, "s_change")
    assert rows(spark.table(name)) == rows(spark.createDataFrame(ROWS, SCHEMA))
    W.write_update(change(spark, (1, "A"), (4, "D"), (9, "none")), name, ["id"])
    assert rows(spark.table(name)) == [(1, "A", "p1", 1), (2, "b", "p2", 1), (3, "c", "p3", 2), (4, "D", None, 2), (5, "e", "p1", 2)]
    W.write_update(spark.createDataFrame([(2, "p3", 2), (5, None, 2)], "id int, p string, q int"), name, ["id"])
    W.write_upsert(spark.createDataFrame([(3, "C", "new", 7), (6, "f", "p2", 1)], SCHEMA), name, ["id"])
    W.write_upsert(change(spark, (6, "F")), name, ["id"], on_duplicate=["v"], insertable=["id", "v"])
    assert rows(spark.table(name)) == [(1, "A", "p1", 1), (2, "b", "p3", 2), (3, "C", "new", 7), (4, "D", None, 2), (5, "e", None, 2),
                                       (6, "F", "p2", 1)]


def test_only_touched_partitions_are_written(spark):
    name = made(spark, "s_touched")
    listed = lambda: {(r.p, r.q): r[S.MARK] for r in S._listed(S.snapshot(spark, name), spark).collect()}
    before = listed()
    assert len(before) == 5 and before.keys() == {(r[2], r[3]) for r in ROWS}
    version = W.write_update(change(spark, (2, "B")), name, ["id"])
    after = listed()
    assert {k for k in before if before[k] != after[k]} == {("p2", 1)} and S.snapshot(spark, name).version == version
    assert W.write_update(change(spark, (99, "none")), name, ["id"]) == version


def test_a_partition_without_rows_goes(spark):
    name = made(spark, "s_gone")
    W.write_update(spark.createDataFrame([(3, "p1")], "id int, p string"), name, ["id"])
    assert {r.p for r in S._listed(S.snapshot(spark, name), spark).collect()} == {"p1", "p2", None}
    assert spark.table(name).count() == 5


class Killed(Exception):
    pass


@pytest.mark.parametrize("step", ["files of some partitions", "all files", "list", "before the commit"])
def test_a_run_that_stops_shows_all_old_rows(spark, monkeypatch, step):
    """Stopped after k of n partitions are written, after all, after the list: the old rows stay, and the next run is whole."""
    name = made(spark, f"s_stop_{step.replace(' ', '_')}")
    wanted = change(spark, *((i, "new") for i in range(1, 6)))
    with monkeypatch.context() as patch:
        if step == "files of some partitions":
            write = S._write
            patch.setattr(S, "_write", lambda df, of: (write(df.filter("p = 'p1'"), of), kill())[0])
        elif step == "all files":
            patch.setattr(S, "_publish", kill)
        elif step == "list":
            patch.setattr(S, "snapshot", lambda spark, table: kill())
        else:
            patch.setattr(S, "_commit", kill)
        with pytest.raises(Killed):
            W.write_update(wanted, name, ["id"])
    assert rows(spark.table(name)) == rows(spark.createDataFrame(ROWS, SCHEMA))
    W.write_update(wanted, name, ["id"])
    assert {r.v for r in spark.table(name).collect()} == {"new"} and spark.table(name).count() == 5


def kill(*_):
    raise Killed


def test_a_reader_keeps_its_version_and_earlier_ones_come_back(spark):
    name = made(spark, "s_versions")
    first, open_before = S.snapshot(spark, name).version, spark.table(name)
    W.write_update(change(spark, (1, "A")), name, ["id"])
    assert rows(open_before) == rows(S.as_of(spark, name, first)) == rows(spark.createDataFrame(ROWS, SCHEMA))
    assert rows(spark.table(name)) != rows(open_before)
    assert [(r.p, r.q) for r in S.unlisted(spark, name).collect()] == [("p1", 1)] and S.unlisted(spark, name, [first]).count() == 0
    S.roll_back(spark, name, first)
    assert rows(spark.table(name)) == rows(open_before)
    with pytest.raises(ValueError):
        S.roll_back(spark, name, "none")


def test_a_second_writer_gives_up(spark):
    name = made(spark, "s_race")
    stale = S.snapshot(spark, name)
    W.write_update(change(spark, (1, "A")), name, ["id"])
    held = rows(spark.table(name))
    with pytest.raises(RuntimeError, match="during a write"):
        S.change_snapshot(stale, spark.createDataFrame([("p2", 1)], "p string, q int"), lambda part: part)
    assert rows(spark.table(name)) == held


def test_rows_for_other_partitions_are_an_error(spark):
    name = made(spark, "s_lost")
    with pytest.raises(ValueError, match="not read"):
        S.change_snapshot(S.snapshot(spark, name), spark.createDataFrame([("p2", 1)], "p string, q int"), lambda part: part.withColumn("p", F.lit("p9")))
    assert rows(spark.table(name)) == rows(spark.createDataFrame(ROWS, SCHEMA))


def test_a_filter_reaches_the_partitions_of_a_snapshot(spark):
    plan = spark.table(made(spark, "s_plan")).filter("p = 'p1'")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*p#\d+ = p1", plan) and "dynamicpruning" in plan.lower()


def exchanges_over(plan, table_folder):
    """Exchanges between the root of a plan and the scan of a folder."""
    depth, above = [], None
    for line in plan.splitlines():
        level = len(line) - len(line.lstrip(" :+-*()0123456789"))
        depth = [d for d in depth if d[0] < level] + [(level, line)]
        if table_folder in line:
            above = [text for _, text in depth if "Exchange" in text]
    return above


def test_an_upsert_leaves_a_bucketed_table_unshuffled(spark, tmp_path):
    folder = str(tmp_path / "buckets")
    keep = spark.range(2000).select(F.col("id"), F.lit("old").alias("v"))
    W.as_bucketed(keep, "t_buckets", ["id"], 5, folder)
    changes = spark.range(1990, 2010).select("id", F.lit("new").alias("v"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for _ in range(2):
            made = W.upserted(spark.table("t_buckets"), changes, ["id"], spread=5)
            plan = made._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" in plan and exchanges_over(plan, "t_buckets") == []
            W.write_upsert(changes, "t_buckets", ["id"], fits=False)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert spark.table("t_buckets").groupBy("v").count().collect() in (
        [("old", 1990), ("new", 20)], [("new", 20), ("old", 1990)])
    assert W.bucketing(spark, "t_buckets") == (5, ["id"], ["id"])
    by_bucket = {}
    for r in spark.table("t_buckets").select("id", "_metadata.file_name").collect():
        by_bucket.setdefault(re.search(r"_(\d{5})\.c", r.file_name)[1], set()).add(r.id)
    assert len(by_bucket) == 5 and sum(map(len, by_bucket.values())) == 2010


def test_a_run_counts_once(spark):
    first = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    first.withColumn("run", F.lit("")).limit(0).write.saveAsTable("t_run_plain")
    for name in ("t_run_plain", "t_run_parts"):
        for part, run in ((first, "r1"), (first, "r2"), (first.limit(1), "r1"), (first.limit(0), "r2")):
            W.write_run(part, name, {"run": run})
        assert rows(spark.table(name), "run") == [("r1",)]


def test_a_flow_run_twice_leaves_its_tables_alike(spark):
    people = spark.createDataFrame([("1", "Ann", "HR", 5500, "30"), ("2", "ann", "HR", 1, "31"), ("3", "Bob", None, 7000, "40")],
                                   "ID string, NAME string, DEPT string, SAL int, AGE string")
    W.as_table(people.withColumns({c: F.lit(None).cast("string") for c in ("SAL_RANGE", "DATE_TIMESTAMP")}), "t_twice")
    people.withColumn("run", F.lit("")).limit(0).write.saveAsTable("t_twice_more")
    for at in (datetime(2024, 1, 2), datetime(2024, 1, 2), datetime(2024, 1, 3), datetime(2024, 1, 2)):
        employee.run(spark, people, at, "t_twice", "t_twice_more", "t_twice_reject", ["ID"])
    for name in ("t_twice_more", "t_twice_reject"):
        assert rows(spark.table(name), "run") == [("2024-01-02T00:00:00",), ("2024-01-03T00:00:00",)]


def test_a_repeated_batch_adds_no_row_without_a_key(spark, tmp_path):
    schema, folder = "id int, v string, at int", str(tmp_path / "in")
    for n, batch in enumerate(([(1, "a", 10), (None, "n", 10)], [(None, "n", 10), (None, "late", 3), (None, "past", 12), (2, "b", 11)])):
        for repeat in range(2):  # a lost checkpoint makes the batch come again
            spark.createDataFrame(batch, schema).write.mode("overwrite").parquet(f"{folder}{n}")
            load_new(spark.readStream.schema(schema).parquet(f"{folder}{n}"), "t_again", ["id"], ["at"], str(tmp_path / f"cp{n}{repeat}"))
    assert rows(spark.table("t_again")) == [(None, "n", 10), (None, "past", 12), (1, "a", 10), (2, "b", 11)]
    assert rows(spark.table(W.unkeyed_table("t_again"))) == [(None, "late", 3)]


@pytest.mark.parametrize("share,least", [(0.05, 1), (0.2, 1), (0.05, 400), (0.6, 1)])
def test_the_sketch_finds_just_the_hot_keys(spark, share, least):
    df = spark.range(5000).select(F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 10 == 1, 9).otherwise(F.col("id") + 100).alias("k"))
    got = hot_hashes(df, [F.col("k")], share, least)
    want = df.groupBy("k").count().filter((F.col("count") > share * 5000) & (F.col("count") >= least)).select(F.xxhash64("k"))
    assert rows(got) == rows(want)


def test_the_sketch_passes_on_a_bounded_number_of_records(spark):
    df = spark.range(0, 400_000, 1, 4).select(F.col("id").alias("k"))
    got = hot_hashes(df, [F.col("k")], 0.05, 1)
    assert got.collect() == [] and sketch_cells(0.05) == 256
    text = got._jdf.queryExecution().executedPlan().toString()
    first = [line for line in text.splitlines() if "HashAggregate(keys=[__cell" in line]
    assert first and "__hot" not in first[-1]
