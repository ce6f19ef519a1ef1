"""A sink that refuses rows by its own rule: what it takes and gives back, also when tasks fail and run again."""

import subprocess
import sys
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rowmill.functions.sqltests import register_tests
from rowmill.sinks.refusing import FileSink, RowSink, write_to_sink

ROOT = Path(__file__).resolve().parents[1]


def odd():
    """Made anew, so that it travels to the workers whole: they do not know the tests."""
    return lambda row: ("7", f"no {row.id}") if row.id % 2 else None


def test_taken_and_refused_rows_make_the_input(spark, tmp_path):
    df = spark.range(0, 1000, 1, 7).select("id", F.concat(F.lit("n"), "id").alias("name"))
    folder = str(tmp_path / "out")
    back = write_to_sink(df, FileSink(folder, df.schema, odd()), batch_rows=33)
    assert rows(back) == rows(df.filter("id % 2 = 1").withColumns({"errorCode": F.lit("7"), "errorMessage": F.concat(F.lit("no "), "id")}))
    assert rows(spark.read.parquet(folder)) == rows(df.filter("id % 2 = 0"))


def test_a_refused_row_comes_back_as_it_went(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "ü\n\"", datetime(2024, 1, 2, 3, 4, 5, 678901), date(2024, 2, 29), 0.1, None, [1, None], {"k": 1.5}, bytearray(b"\x00\xff"))],
        "id int, s string, at timestamp_ntz, day date, x double, n string, a array<int>, m map<string,double>, b binary")
    back = write_to_sink(df, FileSink(str(tmp_path / "out"), df.schema, odd()))
    assert back.drop("errorCode", "errorMessage").collect() == df.collect()


def test_nothing_refused_and_nothing_written(spark, tmp_path):
    df = spark.range(4).filter("id % 2 = 0")
    back = write_to_sink(df, FileSink(str(tmp_path / "a"), df.schema, odd()))
    assert back.collect() == [] and back.columns == ["id", "errorCode", "errorMessage"]
    assert write_to_sink(df.limit(0), FileSink(str(tmp_path / "b"), df.schema, odd())).count() == 0


def test_a_failed_write_is_aborted(spark, tmp_path):
    class Failing(RowSink):
        def __init__(self, log):
            self.log = log

        def put(self, rows):
            raise ValueError("the sink is gone")

        def commit(self, prepared):
            Path(self.log).write_text("commit")

        def abort(self, prepared):
            Path(self.log).write_text("abort")

    log = tmp_path / "log"
    with pytest.raises(Exception, match="the sink is gone"):
        write_to_sink(spark.range(5), Failing(str(log)))
    assert log.read_text() == "abort"


RETRIED = '''
import os, sys
sys.path.insert(0, {root!r})
from rowmill.session import build_session
from rowmill.sinks.refusing import FileSink, write_to_sink

class Flaky(FileSink):
    """The first attempt of each task takes and refuses rows, prepares its file and then fails."""
    def prepare(self):
        made = super().prepare()
        marker = {folder!r} + "/failed-" + str(min(self.rows)[0])
        if not os.path.exists(marker):
            open(marker, "w").close()
            raise OSError("lost")
        return made

spark = build_session("retry", "local[2,4]")
df = spark.range(0, 100, 1, 3)
back = write_to_sink(df, Flaky({folder!r} + "/out", df.schema, lambda r: ("7", "odd") if r.id % 2 else None), batch_rows=10)
print("refused", sorted(r.id for r in back.collect()) == list(range(1, 100, 2)))
print("taken", sorted(r.id for r in spark.read.parquet({folder!r} + "/out").collect()) == list(range(0, 100, 2)))
print("failures", len([f for f in os.listdir({folder!r}) if f.startswith("failed")]))
'''


def test_a_retried_task_counts_once(tmp_path):
    code = RETRIED.format(root=str(ROOT), folder=str(tmp_path))
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240, env={**__import__("os").environ, "PYTHONPATH": str(ROOT)})
    assert "refused True" in run.stdout and "taken True" in run.stdout and "failures 3" in run.stdout, run.stderr[-2000:]


def test_sql_tests_are_one_scan(spark):
    register_tests(spark)
    people = spark.createDataFrame([("12",), ("x",), (None,), ("-3",)], "v string")
    found = spark.sql("SELECT p.v FROM {p} AS p, LATERAL is_numeric(p.v) AS t WHERE t.failing", p=people)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == [("x",)] and "Join" not in plan and "Exchange" not in plan
    listed = spark.sql("SELECT p.v FROM {p} AS p, LATERAL accepted_values(p.v, array('12', '-3')) AS t WHERE t.failing", p=people)
    assert rows(listed) == [("x",)]
