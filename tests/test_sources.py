import pytest
from pyspark.sql import functions as F
from pyspark.errors import SparkRuntimeException

from conftest import rows
from rowmill.sources import tables as S
from rowmill.sources.delimited import EMPLOYEE, read_delimited, read_lines, read_with_rejects


def put(tmp_path, text, name="in.txt", encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(text.encode(encoding))
    return str(path)


HEAD = "ID|NAME|DEPT|SAL|AGE\n"


def test_trim_blank_lines_and_header(spark, tmp_path):
    path = put(tmp_path, HEAD + " 1 |Ann |HR| 10 |30\r\n\n   \n2||HR||31\n")
    assert rows(read_delimited(spark, path, EMPLOYEE)) == [
        ("1", "Ann", "HR", 10, "30"), ("2", "", "HR", None, "31")]


def test_rejects_keep_the_line(spark, tmp_path):
    path = put(tmp_path, HEAD + "1|a|b|x|3\n2|a|b\n3|a|b|1|2|9\n4|a|b|1|2\n")
    out = read_with_rejects(spark, path, EMPLOYEE, check_fields=True)
    assert rows(out["main"], "ID") == [("4",)]
    assert rows(out["reject"], "line", "errorCode", "errorMessage") == [
        ("1|a|b|x|3", "TYPE", "SAL:type"), ("2|a|b", "FIELDS", "expected 5 fields"),
        ("3|a|b|1|2|9", "FIELDS", "expected 5 fields")]


@pytest.mark.parametrize("action", [lambda df: df.count(), lambda df: df.select("ID").collect()])
def test_a_bad_row_ends_the_run_even_if_its_column_is_not_read(spark, tmp_path, action):
    path = put(tmp_path, HEAD + "1|a|b|x|3\n")
    with pytest.raises(SparkRuntimeException):
        action(read_delimited(spark, path, EMPLOYEE))


@pytest.mark.parametrize("in_memory", [100_000, 0])
def test_header_of_two_lines_and_footer_over_several_files(spark, tmp_path, monkeypatch, in_memory):
    monkeypatch.setattr("rowmill.sources.delimited.FILES_IN_MEMORY", in_memory)
    for i in range(3):
        put(tmp_path, f"made\n{HEAD}{i}|a|b|1|2\n{i + 5}|a|b|1|2\ntotal\n", f"{i}.txt")
    got = read_delimited(spark, str(tmp_path), EMPLOYEE, header=2, footer=1)
    assert rows(got, "ID") == [(str(i),) for i in (0, 1, 2, 5, 6, 7)]


def test_footer_of_a_file_read_in_many_blocks(spark, tmp_path):
    body = "".join(f"{i}|a|b|1|2\n" for i in range(3000))
    path = put(tmp_path, HEAD + body + "t1\nt2\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = read_delimited(spark, path, EMPLOYEE, header=1, footer=2)
        assert got.agg(F.count("*"), F.countDistinct("ID")).first()[:] == (3000, 3000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_latin9(spark, tmp_path):
    path = put(tmp_path, HEAD + "1|José|5 €|1|Šœ\n", encoding="iso-8859-15")
    assert rows(read_delimited(spark, path, EMPLOYEE, encoding="ISO-8859-15")) == [
        ("1", "José", "5 €", 1, "Šœ")]


def test_quoted_separator(spark, tmp_path):
    path = put(tmp_path, HEAD + '1|"a|b"|c|1|2\n')
    assert rows(read_delimited(spark, path, EMPLOYEE, csv=True), "NAME") == [("a|b",)]


def test_a_line_with_the_inner_separator_stays_whole(spark, tmp_path):
    path = put(tmp_path, "head\na\x01b|c\nplain\n")
    assert rows(read_lines(spark, path, header=1)) == [("a\x01b|c",), ("plain",)]


def test_sample_repeats(spark, tmp_path):
    path = put(tmp_path, HEAD + "".join(f"{i}|a|b|1|2\n" for i in range(200)))
    picks = [rows(read_delimited(spark, path, EMPLOYEE, sample_n=10, seed=3), "ID")
             for _ in range(2)]
    assert picks[0] == picks[1] and len(picks[0]) == 10
    assert read_delimited(spark, path, EMPLOYEE, limit=5).count() == 5


def test_seed_and_lossy_text(spark, tmp_path):
    path = put(tmp_path, "code,label\n1,one\n", "seed.csv")
    assert rows(S.seed(spark, path, "seed_labels", "code int, label string")) == [(1, "one")]
    (tmp_path / "bad.bin").write_bytes(b"a\xffb")
    got = S.read_text_lossy(spark, str(tmp_path / "bad.bin"))
    assert rows(got, "text") == [("a�b",)]


def test_size_settings():
    from rowmill.session import size_settings
    assert size_settings(10**9) == {"spark.sql.shuffle.partitions": "200"}
    large = size_settings(100 * 10**12)
    assert large["spark.sql.shuffle.partitions"] == "100000"
    assert large["spark.sql.files.maxPartitionBytes"] == str(512 * 1024 * 1024)


@pytest.mark.parametrize("before,after", [("", ""), ("\n", "\n"), ("\n  \n\n", "\n \n")])
def test_blank_lines_are_neither_header_nor_footer(spark, tmp_path, before, after):
    (tmp_path / "a.txt").write_text(f"{before}ID|NAME\n\n1|a\n{before}2|b\nend\n{after}")
    path = str(tmp_path / "a.txt")
    want = [("1|a",), ("2|b",), ("end",)]
    assert rows(read_lines(spark, path, header=1)) == want
    assert rows(read_lines(spark, path, header=1, footer=1)) == want[:2]
    assert rows(read_lines(spark, path, header=2)) == want[1:]
    assert ("ID|NAME",) in rows(read_lines(spark, path, header=1, remove_empty=False)) or not before
