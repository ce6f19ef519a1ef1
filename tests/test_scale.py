"""What grows with the input: tasks, files and what the parser reads."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from rowmill.operators import jobs as J
from rowmill.queries import files, fixtures, registry
from rowmill.queries.jobs import _RICH, _XML, _files
from rowmill.queries.fixtures import table
from rowmill.operators.blocks import joined_text
from rowmill.sinks import files as files_of_blocks
from rowmill.sinks.files import write_blocks

TABLES = [(J.components, J.COMPONENTS), (J.census, J.COMPONENTS), (J.parameters, J.PARAMETERS), (J.table_parameters, J.PARAMETERS),
          (J.connectors, J.CONNECTORS), (J.columns, J.COLUMNS), (J.column_patterns, J.PATTERNS), (J.links, J.LINKS),
          (J.link_parameters, J.LINK_PARAMETERS), (J.link_table_parameters, J.LINK_PARAMETERS), (J.lineage, J.LINEAGE),
          (J.column_changes, J.CHANGES), (J.dangling_outputs, J.CHANGES), (J.map_inputs, J.MAP_INPUTS),
          (J.map_expressions, J.MAP_EXPRESSIONS)]


@pytest.fixture(scope="module")
def job_files(spark):
    made = _files(table(spark, SMALL, "orders").filter("o_orderkey < 200"), _RICH)
    return made.union(spark.createDataFrame([("odd", "no xml"), ("none", None)], "job string, xml string")).cache()


@pytest.mark.parametrize("build,schema", TABLES, ids=[b.__name__ for b, _ in TABLES])
def test_a_table_needs_no_more_of_a_file_than_its_schema(job_files, build, schema):
    got = build(J.parse_jobs(job_files, schema))
    want = build(J.parse_jobs(job_files))
    assert got.schema == want.schema
    assert rows(got) == rows(want) != []


def test_large_tables_are_spread_over_more_tasks_than_cores(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "ROWS_A_TASK", 100)
    df = table(spark, SMALL, "orders")
    spread = fixtures.spread(df)
    assert spread.rdd.getNumPartitions() == -(-df.count() // 100) > 8
    assert spread.count() == df.count()


def test_files_of_lines_grow_in_number_not_in_size(spark, monkeypatch):
    monkeypatch.setattr(files, "LINES_A_FILE", 100)
    lines = spark.range(1050).selectExpr("id", "CAST(id AS STRING)")
    path = files.write_lines(lines, "head")
    sizes = spark.read.text(path).groupBy("part").count().collect()
    assert len(sizes) == 11 and max(r["count"] for r in sizes) <= 101


def test_tasks_put_files_of_documents_in_place(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string")
    path = str(tmp_path / "blocks")
    seen = []
    write_blocks(df, "doc_id", "text", path)
    for i in range(40):
        (name,) = glob.glob(f"{path}/doc_id={i}/part-*.txt")
        seen.append(open(name).read())
    assert seen == [f"-- model #1\ntext {i}\n\n\n" for i in range(40)]
    assert os.path.exists(f"{path}/_SUCCESS") and not os.path.exists(f"{path}/_temporary")


def test_files_of_documents_are_written_without_hadoops_local_file_system(spark, tmp_path):
    """It starts a process for every file and folder, and leaves a checksum beside each; the files are those it would write."""
    ids = ["1", "a/b=c", "50%", "", None, "é{x} +", "1", 'q"[1]^']
    df = spark.createDataFrame([(v, f"text {i}" if i else None) for i, v in enumerate(ids)], "doc string, text string").coalesce(1)
    path, plain = str(tmp_path / "blocks"), str(tmp_path / "plain")
    write_blocks(df, "doc", "text", path)
    joined_text(df, "doc", "text").withColumnRenamed("text", "value").write.partitionBy("doc").text(plain)

    def written(top):
        return sorted((os.path.basename(os.path.dirname(f)), open(f, "rb").read()) for f in glob.glob(f"{top}/doc=*/part-*.txt"))

    assert written(path) == written(plain) and len(written(path)) == 6
    assert glob.glob(f"{path}/*/.*.crc") == []
    read = spark.read.text(plain, wholetext=True)
    assert rows(spark.read.text(path, wholetext=True), "doc", "value") == rows(read, "doc", "value")
    back = files_of_blocks.read_blocks(spark, path, "doc")
    assert rows(back) == rows(read, "doc", "value") and {r["doc"] for r in back.collect()} == {v or None for v in ids}
    with pytest.raises(Exception, match="exists"):
        write_blocks(df, "doc", "text", path)


def test_a_repeated_attempt_would_use_the_same_names(spark, tmp_path):
    texts = spark.range(0, 6, 1, 2).select("id", F.col("id").cast("string").alias("value"))
    for k in (1, 2):
        files_of_blocks._write_files(texts, "id", str(tmp_path / str(k)))
    first, again = (sorted(os.path.relpath(f, tmp_path / k) for f in glob.glob(f"{tmp_path}/{k}/id=*/*")) for k in "12")
    assert first == again and len(first) == 6


@pytest.mark.parametrize("xml", [_XML, _RICH], ids=["plain", "rich"])
def test_job_texts_are_not_put_together_element_by_element(spark, xml):
    """Also for jobs whose status or customer is missing: a component without its value is left out, as is a job without a key."""
    orders = spark.createDataFrame([(1, 7, "O"), (2, None, "F"), (3, 8, None), (None, 9, "P")],
                                   "o_orderkey long, o_custkey long, o_orderstatus string")
    made = _files(orders, xml)
    assert "transform(" not in made._jdf.queryExecution().optimizedPlan().toString()
    found = J.parse_jobs(made)
    kinds = rows(J.components(found), "job", "component_name", "unique_name")
    assert kinds == [("1", "map", "n1"), ("1", "reader", "n0"), ("1", "writer", "n2"), ("2", "reader", "n0"), ("2", "writer", "n2"),
                     ("2", "writer", "n3")]
    assert made.filter("xml IS NULL").count() == 1
    assert J.links(found).groupBy("job").count().orderBy("job").collect() == [("1", 2), ("2", 4), ("3", 1)]


@pytest.fixture(scope="module")
def own_orders(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("orders"))
    spark.range(1, 251).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "'O' AS o_orderstatus").coalesce(1).write.parquet(f"{folder}/orders.parquet")
    return folder


@pytest.mark.parametrize("name", ["job_map_inputs", "job_table_parameters", "job_link_traces", "job_connectors", "job_map_expressions", "job_links",
                                  "job_link_parameters", "job_parameters", "job_dangling", "job_columns", "job_lineage"])
def test_a_task_of_a_job_query_has_no_more_files_on_a_larger_table(spark, own_orders, monkeypatch, name):
    """A table is built where its files are parsed, so the jobs of a partition are those that its task parsed."""
    monkeypatch.setattr(fixtures, "ROWS_A_TASK", 10)
    built = registry()[name][0](spark, own_orders)
    jobs = built.select("job", F.spark_partition_id().alias("task")).distinct().groupBy("task").count().collect()
    assert len(jobs) == 25 and max(r["count"] for r in jobs) <= 10
