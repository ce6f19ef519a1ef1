from datetime import datetime

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import Row, functions as F

from conftest import rows
from rowmill.operators.lookup import close_pairs, lookup, similar_pairs
from rowmill.operators.project import (
    convert_to, empty_like, map_columns, schema_diff, split_columns)
from rowmill.operators.skew import fits_in_memory
from rowmill.plans import employee, models
from rowmill.sinks import tables as W, versions
from rowmill.streaming.incremental import load_new

HOT = {"share": 0.0, "rows": 1}
WAYS = [{}, HOT, {"fits": True}]


def target(spark):
    return spark.createDataFrame([(1, "a", 1), (2, "b", 2), (2, "bb", 3), (None, "n", 4)],
                                 "id int, name string, n int")


def source(spark):
    return spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1), (None, "q", 1)],
                                 "id int, name string, seq int")


@pytest.mark.parametrize("skew", WAYS)
def test_update_last_row_wins_and_unmatched_rows_are_ignored(spark, skew):
    got = W.updated(target(spark), source(spark), ["id"], ["seq"], **skew)
    assert rows(got) == [(None, "n", 4), (1, "a", 1), (2, "y", 2), (2, "y", 3)]


def test_update_null_safe(spark):
    got = W.updated(target(spark), source(spark), ["id"], ["seq"], null_safe=True)
    assert (None, "q", 4) in rows(got)


def test_update_without_keys_is_an_error(spark):
    with pytest.raises(ValueError):
        W.updated(target(spark), source(spark), [])


@pytest.mark.parametrize("skew", WAYS)
def test_upsert(spark, skew):
    got = W.upserted(target(spark), source(spark), ["id"], ["seq"], **skew)
    assert rows(got) == [(None, "n", 4), (None, "q", None), (1, "a", 1), (2, "y", None),
                         (3, "z", None)]


@pytest.mark.parametrize("skew", WAYS)
def test_insert_or_update_only_the_named_columns(spark, skew):
    more = source(spark).union(spark.createDataFrame([(3, "last", 9)], "id int, name string, n int"))
    got = W.inserted_or_updated(target(spark), more.withColumn("n", F.col("seq") * 10), ["id"],
                                ["seq"], on_duplicate=["n"], **skew)
    assert rows(got) == [(None, "n", 4), (None, "q", 10), (1, "a", 1), (2, "b", 20), (2, "bb", 20),
                         (3, "z", 90)]


def test_delete(spark):
    assert rows(W.deleted(target(spark), source(spark), ["id"]), "n") == [(1,), (4,)]


def test_insert_needs_a_table(spark):
    with pytest.raises(ValueError):
        W.write_insert(source(spark), "no_such_table")


def test_insert_by_name_with_mask(spark):
    W.as_table(target(spark), "t_insert")
    W.write_insert(source(spark).withColumn("n", F.col("seq")), "t_insert",
                   insertable=["id", "name"])
    assert spark.table("t_insert").count() == 8
    assert spark.table("t_insert").filter("name = 'x'").first()["n"] is None


def test_update_keeps_the_old_version(spark):
    W.as_table(target(spark), "t_update")
    old = W.write_update(source(spark), "t_update", ["id"], ["seq"])
    again = W.write_update(source(spark), "t_update", ["id"], ["seq"])
    assert rows(spark.table("t_update"), "name") == [("a",), ("n",), ("y",), ("y",)]
    assert old != again and spark.read.parquet(old).count() == 4


def parted(spark, name):
    df = spark.createDataFrame(
        [(1, "a", "x y"), (2, "b", "x y"), (3, "c", "it's"), (4, "d", None), (5, "e", "z+1/2")],
        "id int, name string, place string")
    W.as_table(df, name, ["place"])


def test_update_of_a_partitioned_table_rewrites_only_what_it_touches(spark):
    parted(spark, "t_parts")
    before = {r["id"]: r["f"] for r in spark.table("t_parts")
              .select("id", F.col("_metadata.file_path").alias("f")).collect()}
    source = spark.createDataFrame([(3, "C"), (4, "D"), (9, "no")], "id int, name string")
    W.write_update(source, "t_parts", ["id"])
    after = spark.table("t_parts").select("id", "name", "place",
                                          F.col("_metadata.file_path").alias("f")).collect()
    assert sorted((r["id"], r["name"], r["place"]) for r in after) == [
        (1, "a", "x y"), (2, "b", "x y"), (3, "C", "it's"), (4, "D", None), (5, "e", "z+1/2")]
    assert {r["id"] for r in after if r["f"] == before[r["id"]]} == {1, 2, 5}


def test_upsert_moves_rows_between_partitions_and_empties_one(spark):
    parted(spark, "t_moves")
    source = spark.createDataFrame([(3, "C", "x y"), (6, "f", "new"), (5, "E", "z+1/2")],
                                   "id int, name string, place string")
    W.write_upsert(source, "t_moves", ["id"])
    want = [(1, "a", "x y"), (2, "b", "x y"), (3, "C", "x y"), (4, "d", None), (5, "E", "z+1/2"),
            (6, "f", "new")]
    assert rows(spark.table("t_moves")) == want
    W.write_update(spark.createDataFrame([(6, "it's")], "id int, place string"), "t_moves", ["id"])
    want[-1] = (6, "f", "it's")
    assert rows(spark.table("t_moves")) == want


def test_update_of_a_table_with_two_partition_columns(spark):
    df = spark.createDataFrame([(i, f"p{i % 3}" if i % 3 else None, i % 2, "old") for i in range(12)],
                               "id int, a string, b int, v string")
    W.as_table(df, "t_two", ["a", "b"])
    files = {r["id"]: r["f"] for r in spark.table("t_two")
             .select("id", F.col("_metadata.file_path").alias("f")).collect()}
    W.write_update(spark.createDataFrame([(0, "new"), (1, "new")], "id int, v string"), "t_two",
                   ["id"])
    after = spark.table("t_two").select("id", "v", F.col("_metadata.file_path").alias("f")).collect()
    assert {r["id"] for r in after if r["v"] == "new"} == {0, 1} and len(after) == 12
    assert {r["id"] for r in after if r["f"] != files[r["id"]]} == {0, 6, 1, 7}


def test_incremental_creates_then_adds(spark):
    first = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "id int, name string, at int")
    assert rows(W.as_incremental(first, "t_incremental", ["id"], "at")) == [(1, "b", 2)]
    later = spark.createDataFrame([(1, "old", 2), (1, "c", 3), (2, "d", 4)], first.schema)
    assert rows(W.as_incremental(later, "t_incremental", ["id"], "at")) == [(1, "c", 3), (2, "d", 4)]


def test_run_writes_three_tables(spark):
    people = spark.createDataFrame(
        [("1", "Ann", "HR", 5500, "30"), ("2", "ann", "HR", 1, "31"), ("3", "Bob", None, 7000, "40")],
        "ID string, NAME string, DEPT string, SAL int, AGE string")
    held = people.select("ID", *[F.lit(None).cast(t).alias(c) for c, t in people.dtypes[1:]],
                         *[F.lit(None).cast("string").alias(c)
                           for c in ("SAL_RANGE", "DATE_TIMESTAMP")])
    W.as_table(held.filter("ID = '1'"), "t_clean")
    W.as_table(people.limit(0), "t_duplicate")
    employee.run(spark, people, datetime(2024, 1, 2), "t_clean", "t_duplicate", "t_reject", ["ID"])
    assert rows(spark.table("t_clean")) == [
        ("1", "Ann", "HR", 5500, "30", "Low", "2024-01-02 00:00:00")]
    assert rows(spark.table("t_duplicate"), "ID") == [("2",)]
    assert rows(spark.table("t_reject"), "ID", "errorCode", "errorMessage") == [
        ("3", "4", "DEPT:empty")]


def test_lookup_size_is_measured(spark):
    lk = spark.range(50).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    assert fits_in_memory(lk, 50) and not fits_in_memory(lk, 49)
    assert not fits_in_memory(lk, 50, max_bytes=10)
    main = spark.range(100)
    for load in ("once", "shuffle"):
        got = lookup(main, lk, {"id": "k"}, ["v"], load=load)
        assert got.columns == ["id", "v"] and got.filter("v is null").count() == 50


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


WORDS = ["", "a", "ab", "ba", "abc", "acb", "bcd", "abcd", "kitten", "sitting", "mitten", "kit", "aa",
         "aaa", "aaaa", "café", "cafe", "cafes"]


@pytest.mark.parametrize("limit", [1, 2, 3])
def test_close_pairs_against_brute_force(spark, limit):
    df = spark.createDataFrame([(w,) for w in WORDS], "w string")
    got = {tuple(r) for r in close_pairs(df, df, "w", "w", limit).collect()}
    want = {(a, b, _distance(a, b)) for a in WORDS for b in WORDS if _distance(a, b) <= limit}
    assert got == want


TEXTS = ["red fox", "fox red", "red", "the red fox", "the fox", "the the dog", "a b c d", "a b c e",
         "a b c d e f", "x"]


@pytest.mark.parametrize("threshold", [0.2, 0.5, 0.6, 1.0])
def test_similar_pairs_against_brute_force(spark, threshold):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = {(r[0], r[1]) for r in similar_pairs(df, df, "t", "t", threshold).collect()}
    sets = {t: set(t.split()) for t in TEXTS}
    want = {(a, b) for a in TEXTS for b in TEXTS
            if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold - 1e-12}
    assert got == want


def test_schema_diff(spark):
    before = spark.createDataFrame([], "a int, b string, c int").schema
    after = spark.createDataFrame([], "a int, b int, d int").schema
    assert schema_diff(before, after) == {"d": "added", "c": "dropped", "b": "changed"}


def test_hook_after_a_model_upserts_it(spark):
    W.as_table(spark.createDataFrame([("1", "old")], "employee_id string, salary_range string"),
               "t_synced")
    raw = spark.createDataFrame([("1", " Ann ", "HR", 5500, "30"), ("2", "Bob", "IT", 7000, "40"),
                                 ("3", "Ann", "IT", 1, "31"), ("4", "Cy", None, 1, "9")],
                                "ID string, NAME string, DEPT string, SAL int, AGE string")
    built = models.build(raw, datetime(2024, 1, 2), "t_hook",
                         after=lambda df: W.write_upsert(df, "t_synced", ["employee_id"]))
    assert rows(spark.table("t_synced")) == [("1", "Low"), ("2", "High")]
    assert rows(built["duplicates"], "employee_id") == [("3",)]
    assert spark.table("t_hook_validated").count() == 2


def test_a_failing_map_expression_ends_the_run(spark):
    df = map_columns(spark.range(2), {"x": "1 div id"})
    with pytest.raises(ArithmeticException):
        df.collect()


def test_convert_and_split(spark):
    df = spark.createDataFrame([("1|a|",), ("|b|c",)], "line string")
    parts = split_columns(df, "line", "|", ["id", "name", "dept"], key="id")
    assert rows(parts) == [("1", "a", None)]
    typed = convert_to(parts, empty_like(spark, "id int, name string").schema)
    assert typed.dtypes == [("id", "int"), ("name", "string")] and rows(typed) == [(1, "a")]


def test_masked_upsert_keeps_every_row(spark):
    spark.createDataFrame([(1, "a", "p1"), (2, "b", "p2"), (9, "n", None)], "id int, v string, p string").write.partitionBy(
        "p").saveAsTable("t_masked")
    source = spark.createDataFrame([(2, "B", "p2"), (3, "C", "p1")], "id int, v string, p string")
    W.write_upsert(source, "t_masked", ["id"], insertable=["id", "v"])
    assert rows(spark.table("t_masked")) == [(1, "a", "p1"), (2, "B", None), (3, "C", None), (9, "n", None)]


def test_rows_for_unread_partitions_are_an_error(spark):
    spark.createDataFrame([(1, "p1"), (2, "p2")], "id int, p string").write.partitionBy("p").saveAsTable("t_unread")
    with pytest.raises(ValueError, match="not read"):
        versions.replace_partitions(spark.createDataFrame([(1, "p1"), (3, "p2")], "id int, p string"), "t_unread", ["p"],
                                    [Row(p="p1")])
    assert rows(spark.table("t_unread")) == [(1, "p1"), (2, "p2")]


def test_a_new_version_keeps_format_and_place(spark, tmp_path):
    for name, kind, cut in (("t_orc", "orc", []), ("t_orc_parts", "orc", ["p"])):
        folder = tmp_path / "x__v_1" / name
        spark.createDataFrame([(1, "a", "p1"), (2, "b", "p2")], "id int, v string, p string").write.format(kind).option(
            "path", str(folder)).partitionBy(*cut).saveAsTable(name)
        for value in ("B", "C"):
            W.write_update(spark.createDataFrame([(2, value)], "id int, v string"), name, ["id"])
        assert rows(spark.table(name)) == [(1, "a", "p1"), (2, "C", "p2")]
    assert versions.table_location(spark, "t_orc").startswith(f"file:{tmp_path}/x__v_1/t_orc__v_")
    assert versions.table_location(spark, "t_orc").count("__v_") == 2


def test_late_rows_are_taken_but_turn_nothing_back(spark):
    first = spark.createDataFrame([(1, "new", 10)], "id int, v string, at int")
    W.as_incremental(first, "t_late", ["id"], "at")
    later = spark.createDataFrame([(1, "old", 5), (2, "tie", 10), (3, "none", None), (4, "late", 9), (None, "nobody", 10)],
                                  "id int, v string, at int")
    assert rows(W.as_incremental(later, "t_late", ["id"], "at")) == [(1, "new", 10), (2, "tie", 10), (3, "none", None)]
    assert rows(W.as_incremental(later, "t_late", ["id"], "at", F.lit(5))) == [
        (1, "new", 10), (2, "tie", 10), (3, "none", None), (4, "late", 9)]


def test_late_rows_without_a_key_are_returned(spark):
    schema = "id int, v string, at int, m map<string,int>"
    W.as_incremental(spark.createDataFrame([(1, "a", 10, None), (None, "held", 10, {"x": 1}), (None, "held", None, None)], schema),
                     "t_unkeyed_late", ["id"], "at")
    later = spark.createDataFrame([
        (1, "b", 11, None), (None, "held", 10, {"x": 1}), (None, "held", 10, {"x": 1}), (None, "tie", 10, None), (None, "old", 3, None),
        (None, "held", None, None), (None, "timeless", None, None), (None, "past", 12, None)], schema)
    for _ in range(2):
        assert rows(W.as_incremental(later, "t_unkeyed_late", ["id"], "at"), "id", "v", "at") == [
            (None, "held", None), (None, "held", 10), (None, "past", 12), (1, "b", 11)]
        assert rows(spark.table(W.unkeyed_table("t_unkeyed_late")), "id", "v", "at") == [
            (None, "held", 10), (None, "old", 3), (None, "tie", 10), (None, "timeless", None)]


def test_loads_without_any_time_repeat_nothing(spark):
    timeless = spark.createDataFrame([(None, "a", None), (1, "b", None)], "id int, v string, at int")
    for _ in range(3):
        loaded = W.as_incremental(timeless, "t_timeless", ["id"], "at")
    assert rows(loaded) == [(None, "a", None), (1, "b", None)]
    assert not spark.catalog.tableExists(W.unkeyed_table("t_timeless"))


def test_a_late_batch_of_a_stream_turns_nothing_back(spark, tmp_path):
    schema = "id int, v string, at int"
    for batch in ([(1, "new", 10)], [(1, "old", 5), (2, "b", 1)]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(str(tmp_path / "in"))
        load_new(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "t_late_stream", ["id"], ["at"], str(tmp_path / "cp"))
    assert rows(spark.table("t_late_stream")) == [(1, "new", 10), (2, "b", 1)]
