from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from conftest import rows
from rowmill.functions import scalars as S
from rowmill.operators import checks as C
from rowmill.operators.compliance import (
    ColumnRule, compliance, positional_rules, rules_from_schema, tag_compliance)
from rowmill.operators.summary import error_summary, flow_counts, freshness, metered

RULES = [ColumnRule("id"), ColumnRule("name", nullable=False, max_length=5),
         ColumnRule("sal", "int", nullable=False, max_length=4)]


def codes(spark, data, **options):
    df = spark.createDataFrame(data, "id string, name string, sal string")
    return [(r["errorCode"], r["errorMessage"])
            for r in tag_compliance(df, RULES, **options).collect()]


@pytest.mark.parametrize("row, code, message", [
    (("1", "Ann", "10"), None, None),
    ((None, "Ann", "10"), None, None),
    (("1", "", "10"), "4", "name:empty"),
    (("1", None, "10"), "4", "name:empty"),
    (("1", "Annabel", "10"), "8", "name:length"),
    (("1", "Ann", "x"), "2", "sal:type"),
    (("1", "Ann", "12345x"), "10", "sal:type+length"),
    (("1", "", "x"), "16", "name:empty;sal:type"),
])
def test_codes(spark, row, code, message):
    assert codes(spark, [row]) == [(code, message)]


def test_substring_shortens_instead(spark):
    df = spark.createDataFrame([("1", "Annabel", "10")], "id string, name string, sal string")
    assert rows(compliance(df, RULES, substring=True)["pass"]) == [("1", "Annab", "10")]


def test_empty_is_kept_when_not_null(spark):
    assert codes(spark, [("1", "", "10")], empty_is_null=False) == [(None, None)]


@pytest.mark.parametrize("mode, text, good", [
    ("strict", "2024-01-05", True), ("strict", "2024-1-5", False), ("strict", "2024-13-01", False),
    ("lenient", "2024-1-5", True), ("lenient", "2024-13-01", False),
    ("fast", "2024-13-01", True), ("fast", "2024-1-5", False)])
def test_date_modes(spark, mode, text, good):
    df = spark.createDataFrame([(text,)], "day string")
    rule = ColumnRule("day", "date", pattern="yyyy-MM-dd")
    assert compliance(df, [rule], date_mode=mode)["pass"].count() == int(good)


def test_date_zone_ignored(spark):
    df = spark.createDataFrame([("2024-01-05 10:00:00+02:00",)], "at string")
    rule = ColumnRule("at", "timestamp", pattern="yyyy-MM-dd HH:mm:ss")
    assert compliance(df, [rule])["pass"].count() == 0
    assert compliance(df, [rule], ignore_timezone=True)["pass"].count() == 1


def test_unknown_date_mode(spark):
    with pytest.raises(ValueError):
        tag_compliance(spark.createDataFrame([("a",)], "c string"), [], date_mode="other")


def test_rules_from_schema(spark):
    schema = T.StructType([T.StructField("a", T.StringType(), False, {"length": 3}),
                           T.StructField("b", T.DecimalType(8, 2), True, {"precision": -1})])
    assert rules_from_schema(schema) == [ColumnRule("a", "string", False, 3),
                                         ColumnRule("b", "decimal(8,2)", True)]


def test_precision(spark):
    df = spark.createDataFrame([("1.25",), ("1.20",), ("7",)], "n string")
    rule = ColumnRule("n", "decimal(8,2)", precision=1)
    assert rows(compliance(df, [rule])["reject"], "n", "errorCode") == [("1.25", "8")]


def test_parts_make_up_the_input(spark):
    df = spark.createDataFrame([("1", "", "x"), ("2", "b", "3")], "id string, name string, sal string")
    out = compliance(df, RULES)
    assert out["pass"].count() + out["reject"].count() == 2
    assert rows(error_summary(out["reject"])) == [("16", 1)]


@pytest.mark.parametrize("pay, label", [(5499, "Low"), (5500, "Low"), (5501, "Medium"),
                                        (6500, "Medium"), (6501, "High"), (None, "Medium")])
def test_band(spark, pay, label):
    df = spark.createDataFrame([(pay,)], "pay int")
    assert df.select(S.band(F.col("pay"))).first()[0] == label


def test_strip_takes_all_white_space(spark):
    df = spark.createDataFrame([(" \n\t　a b \r\n",)], "t string")
    assert df.select(S.strip(F.col("t"))).first()[0] == "a b"


@pytest.mark.parametrize("text, value", [("0x1F", "31"), ("-0x1f", "-31"), ("#ff", "255"),
                                         ("017", "15"), ("-017", "-15"), ("0", "0"), ("19", "19"),
                                         ("abc", "abc"), (None, None)])
def test_decode_number(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(S.decode_number(F.col("t"))).first()[0] == value


AS_OF = datetime(2024, 5, 1)


@pytest.mark.parametrize("hours, status", [(24, "pass"), (25, "warn"), (72, "warn"), (73, "error"),
                                           (None, "error")])
def test_freshness(spark, hours, status):
    data = [] if hours is None else [(AS_OF - timedelta(hours=hours),)]
    df = spark.createDataFrame(data, "at timestamp")
    got = freshness(df, "at", AS_OF).first()
    assert (got["age_hours"], got["status"]) == (hours, status)


def test_null_passes_expression_and_accepted(spark):
    df = spark.createDataFrame([(None,), (-1,)], "n int")
    out = C.run_tests(df, {"expr": C.holds("n >= 0"), "values": C.accepted("n", [-1]),
                           "range": C.in_range("n", 0)})
    assert rows(out) == [("expr", 1, "fail"), ("range", 1, "fail"), ("values", 0, "pass")]


def test_assert_empty(spark):
    df = spark.createDataFrame([("HR",)], "dept string")
    C.assert_empty(df.filter(~F.col("dept").isin("HR")))
    with pytest.raises(AssertionError):
        C.assert_empty(df, "departments")


def test_metered_counts_without_a_job_of_its_own(spark):
    df, meter = metered(spark.range(7), "link")
    df.collect()
    assert meter.get == {"n_rows": 7}
    assert rows(flow_counts({"a": spark.range(2)})) == [("a", 2)]


def test_precision_of_doubles(spark):
    df = spark.createDataFrame([(0.00001234,), (1.239,), (1.23,), (1.5e10,)], "x double")
    out = compliance(df, [ColumnRule("x", "double", precision=2)])
    assert sorted(r.x for r in out["reject"].collect()) == [0.00001234, 1.239]


def test_positional_rules_need_as_many_columns(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    with pytest.raises(ValueError):
        positional_rules(df, spark.createDataFrame([], "n string").schema)


def test_a_folder_of_our_own_only_in_local_mode(spark):
    from types import SimpleNamespace

    from rowmill.session import shared_folder

    def session(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None),
                               sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))

    assert shared_folder(session("local[2]"))
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError):
            shared_folder(session(master))
