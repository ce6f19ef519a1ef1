from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from rowmill.operators.dedupe import any_per_key, first_per_key, tag_duplicates, uniq

HOT = {"share": 0.0, "rows": 1, "salts": 3}
PATHS = [{}, HOT, {"share": 0.4, "rows": 1, "salts": 4}]


def people(spark):
    return spark.createDataFrame(
        [("9", "Ann"), ("10", "ann"), ("3", "ANN"), ("4", None), ("5", None), ("6", "Bob")],
        "id string, name string")


@pytest.mark.parametrize("skew", PATHS)
def test_case_folding_and_text_order(spark, skew):
    out = uniq(people(spark), ["name"], ["id"], {"name": False}, **skew)
    assert rows(out["unique"]) == [("10", "ann"), ("4", None), ("6", "Bob")]
    assert rows(out["duplicate"]) == [("3", "ANN"), ("5", None), ("9", "Ann")]


@pytest.mark.parametrize("skew", PATHS)
def test_case_sensitive_keys_and_null_group(spark, skew):
    out = uniq(people(spark), ["name"], ["id"], **skew)
    assert rows(out["duplicate"]) == [("5", None)]
    assert out["unique"].count() == 5


def test_once_gives_one_row_per_repeated_key(spark):
    out = uniq(people(spark), ["name"], ["id"], {"name": False}, once=True)
    assert rows(out["duplicate"]) == [("3", "ANN"), ("5", None)]


def test_no_keys_is_an_error(spark):
    with pytest.raises(ValueError):
        uniq(people(spark), [], ["id"])


@pytest.mark.parametrize("skew", PATHS)
def test_a_third_of_all_rows_are_copies(spark, skew):
    copies = spark.range(0, 400, 1, 8).select(F.lit("same").alias("k"), F.lit(1).alias("v"))
    others = spark.range(0, 800, 1, 8).select((F.col("id") % 300).cast("string").alias("k"),
                                              F.col("id").cast("int").alias("v"))
    data = copies.union(others)
    tagged = tag_duplicates(data, ["k"], ["v"], **skew)
    counts = {r["k"]: (r["u"], r["n"]) for r in tagged.groupBy("k").agg(
        F.count_if(F.col("route") == "unique").alias("u"), F.count("*").alias("n")).collect()}
    assert counts["same"] == (1, 400)
    assert all(u == 1 for u, _ in counts.values()) and sum(n for _, n in counts.values()) == 1200


def test_hot_rows_are_salted_over_partitions(spark):
    data = spark.range(0, 1000, 1, 8).select(F.lit("one").alias("k"), F.col("id").alias("v"))
    plan = tag_duplicates(data, ["k"], ["v"], **HOT)._jdf.queryExecution().toString()
    assert "__salt" in plan and "__lane" in plan


def test_first_per_key_limits_before_the_shuffle(spark):
    data = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = first_per_key(data, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


@pytest.mark.parametrize("skew", PATHS)
def test_named_tie_break_reads_no_other_column(spark, tmp_path, skew):
    data = spark.range(60).select((F.col("id") % 4).alias("k"), "id", F.lit("wide").alias("w"))
    data.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = uniq(df, ["k"], ["id"], tie_break=(), **skew)
    assert rows(out["unique"], "id") == [(0,), (1,), (2,), (3,)]
    assert out["duplicate"].count() == 56
    for part in out.values():
        plan = part.select("id")._jdf.queryExecution().executedPlan().toString()
        assert "w:string" not in plan


def test_any_per_key(spark):
    assert rows(any_per_key(people(spark), ["name"]), "name") == [
        (None,), ("ANN",), ("Ann",), ("Bob",), ("ann",)]


def test_map_columns_do_not_take_part_in_the_order(spark):
    data = spark.createDataFrame([("a", 2, {"x": 1}), ("a", 1, {"x": 2})],
                                 "k string, v int, m map<string,int>")
    assert [r["v"] for r in uniq(data, ["k"], ["v"], **HOT)["duplicate"].collect()] == [2]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "A", "b", None]), st.integers(0, 3)), min_size=1,
                max_size=25))
def test_split_loses_and_doubles_nothing(spark, data):
    df = spark.createDataFrame(data, "k string, v int").repartition(3)
    out = uniq(df, ["k"], ["v"], {"k": False}, **HOT)
    unique = [tuple(r) for r in out["unique"].collect()]
    duplicate = [tuple(r) for r in out["duplicate"].collect()]
    assert Counter(unique + duplicate) == Counter(data)
    keys = [k and k.lower() for k, _ in unique]
    assert len(keys) == len(set(keys)) == len({k and k.lower() for k, _ in data})
