import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rowmill.functions.fences import SQL_FENCE, sql_blocks
from rowmill.operators import blocks as B, jobs as J

TEXTS = {
    "none": "select 1",
    "one": "say\n```sql\nselect 1\n```\n",
    "untagged": "```\nselect 2\n```",
    "adjacent": "```sql\na\n```\n```sql\nb\n```",
    "yaml first": "```yaml\nx: 1\n```\nprose\n```sql\nselect 3\n```\nmore\n```sql\nselect 4\n```",
    "indented": "  ```sql\n  select 5\n  ```",
    "empty": "```sql\n\n```",
    "open": "```sql\nselect 6",
}


def docs(spark):
    return spark.createDataFrame(list(TEXTS.items()), "doc string, text string")


def test_blocks_are_those_of_the_pattern(spark):
    got = {r["doc"]: r["b"] for r in
           docs(spark).select("doc", sql_blocks(F.col("text")).alias("b")).collect()}
    assert got == {d: re.findall(SQL_FENCE, t) for d, t in TEXTS.items()}


def test_numbered_text_equals_the_grouped_one(spark):
    df = docs(spark)
    grouped = B.join_blocks(B.code_blocks(df, "doc", "text", fallback=True), "doc")
    assert rows(grouped) == rows(B.joined_text(df, "doc", "text"))
    texts = dict(rows(grouped))
    assert texts["adjacent"] == "-- model #1\na\n\n-- model #2\nb\n\n"
    assert texts["none"] == "-- model #1\nselect 1\n\n"


def test_tagged_blocks_lose_no_model(spark):
    got = B.code_blocks(docs(spark), "doc", "text", with_lang=True)
    assert rows(got.filter("doc = 'yaml first'"), "idx", "lang", "block") == [
        (1, "yaml", "x: 1\n"), (2, "sql", "select 3\n"), (3, "sql", "select 4\n")]
    assert rows(got.filter("doc = 'indented'"), "block") == [("  select 5\n",)]


def test_record_round_trip(spark):
    df = spark.createDataFrame([("d", 'a "quoted"\ntext')], "doc string, text string")
    record = B.result_record(df, "doc", "text", {"sql": F.lit("d.sql")})
    assert rows(B.record_files(record, "doc")) == [("d", "sql", "d.sql")]
    assert '\\"quoted\\"' in record.first()["record"]


XML = """<?xml version="1.0"?><x:Job xmlns:x="http://example.org/x" x:version="1">
<node componentName="read" componentVersion="1">
 <elementParameter field="TEXT" name="UNIQUE_NAME" value="r1"/>
 <elementParameter field="TABLE" name="COLS">
  <elementValue elementRef="C" value="ID"/><elementValue elementRef="K" value="true"/>
  <elementValue elementRef="C" value="NM"/>
  <elementValue elementRef="C" value="AG"/><elementValue elementRef="K" value="false"/>
 </elementParameter>
 <metadata connector="FLOW" name="r1"><column name="ID" type="id_String" length="-1"
  precision="-1" nullable="true" key="false"/></metadata>
 <metadata connector="REJECT" name="REJECT"><column name="e" type="id_String" length="255"
  precision="0" nullable="true" key="false"/></metadata></node>
<node componentName="map" componentVersion="2">
 <elementParameter field="TEXT" name="UNIQUE_NAME" value="m1"/>
 <metadata connector="FLOW" name="out"><column name="ID" type="id_Integer" length="-1"
  precision="-1" nullable="true" key="false"/><column name="B" type="id_String" length="-1"
  precision="-1" nullable="true" key="false"/></metadata>
 <nodeData><varTables name="Var"><mapperTableEntries name="v" expression="row.ID"/>
  <mapperTableEntries name="v1" expression="Var.v + &quot;$\\&quot;"/></varTables>
  <outputTables name="out"><mapperTableEntries name="ID" expression="Var.v1 "/>
  <mapperTableEntries name="B" expression="f(Var.v1, Var.v)"/></outputTables></nodeData></node>
<node componentName="write" componentVersion="1">
 <elementParameter field="TEXT" name="UNIQUE_NAME" value="w1"/></node>
<connection connectorName="FLOW" label="a" source="r1" target="m1"/>
<connection connectorName="FLOW" label="b" source="m1" target="w1"/></x:Job>"""


@pytest.fixture(scope="module")
def jobs(spark):
    return J.parse_jobs(spark.createDataFrame([("j", XML), ("no job", "plain")],
                                              "job string, xml string"))


def test_groups_begin_where_the_first_name_repeats(jobs):
    assert rows(J.table_parameters(jobs), "row", F.to_json("values")) == [
        (1, '{"C":"ID","K":"true"}'), (2, '{"C":"NM"}'), (3, '{"C":"AG","K":"false"}')]


def test_lineage_and_dangling(jobs):
    assert rows(J.lineage(jobs), "source", "target", "distance") == [
        ("m1", "w1", 1), ("r1", "m1", 1), ("r1", "w1", 2)]
    assert rows(J.dangling_outputs(jobs), "unique_name", "connector") == [("r1", "REJECT")]


def test_lineage_ends_on_a_cycle(spark):
    xml = ('<j><connection connectorName="F" label="1" source="a" target="b"/>'
           '<connection connectorName="F" label="2" source="b" target="a"/></j>')
    jobs = J.parse_jobs(spark.createDataFrame([("j", xml)], "job string, xml string"))
    assert rows(J.lineage(jobs), "source", "target", "distance") == [
        ("a", "a", 2), ("a", "b", 1), ("b", "a", 1), ("b", "b", 2)]


def test_column_changes(jobs):
    assert rows(J.column_changes(jobs), "label", "column", "change") == [
        ("a", "B", "added"), ("a", "ID", "changed")]


def test_map_expressions(jobs):
    assert rows(J.map_expressions(jobs), "column", "expression") == [
        ("B", 'f((row.ID + "$\\"), row.ID)'.replace("(row.ID + ", "((row.ID) + ")
         .replace(", row.ID)", ", (row.ID))")),
        ("ID", '(row.ID) + "$\\"')]


def test_components(jobs):
    assert rows(J.components(jobs), "component_name", "unique_name") == [
        ("map", "m1"), ("read", "r1"), ("write", "w1")]
    assert rows(J.census(jobs)) == [("map", 1, 1), ("read", 1, 1), ("write", 1, 1)]
