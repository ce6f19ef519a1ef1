"""The job catalogue, over job files made from orders: one whole XML text per order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowmill.operators import jobs as J
from rowmill.operators.project import schema_diff
from rowmill.plans.employee import enrich
from rowmill.queries import query
from rowmill.queries.fixtures import employees, spread, table
from rowmill.session import scratch_path
from rowmill.sinks.files import BY_TASKS

# A job has 2 to 4 components in a chain; component i declares columns c0 to ci. The second is a
# map with a variable, the first has a reject output that only even orders link to the last.
# Only the status, the customer and the number of components come from the row: the text of each component and link is put
# together here, once, and not element by element for every job.


def _node(i: int, rich: bool) -> str:
    keys = "".join(f'<elementValue elementRef="COLUMN" value="c{c}"/><elementValue elementRef="KEY" value="{str(c == 0).lower()}"/>'
                   for c in range(i + 1))

    def column(c: int) -> str:
        more = f'pattern="{f"p{i}" if c == 1 else ""}" precision="{i}"' if rich else 'precision="-1"'
        return f'<column key="{str(c == 0).lower()}" length="{i if c == 0 else -1}" name="c{c}" nullable="true" {more} type="id_String"/>'

    kind = ("reader", "map")[i] if i < 2 else "writer"
    side = """<metadata connector="REJECT" name="REJECT"><column key="false"
      length="255" name="errorCode" nullable="true" precision="0" type="id_String"/></metadata>""" if i == 0 else (
        '<metadata connector="OTHER" name="OTHER"/>')
    inputs = ('<inputTables name="row" matchingMode="UNIQUE_MATCH" lookupMode="LOAD_ONCE"/><inputTables name="look"/>' if rich else "")
    maps = f"""<nodeData><varTables name="Var"><mapperTableEntries name="v" expression="(row.c0 &lt;= ', o_custkey, ') ? 1 : 2 "/>\
<mapperTableEntries name="w" expression="Var.v * 3"/></varTables>{inputs}<outputTables name="out">\
<mapperTableEntries name="a" expression="Var.v " type="id_Integer"/><mapperTableEntries name="b" expression="row.c0 " type="id_String"/>\
<mapperTableEntries name="c" expression="Var.w + 1" type="id_Integer"/></outputTables></nodeData>""" if i == 1 else ""
    return f"""concat('<node componentName="{kind}" componentVersion="0.{i}" posX="320">\
<elementParameter field="TEXT" name="UNIQUE_NAME" value="n{i}" show="false"/>\
<elementParameter field="CLOSED_LIST" name="STATUS" value="', o_orderstatus, '"/><elementParameter field="TABLE" name="KEYS">{keys}\
</elementParameter><metadata connector="FLOW" name="n{i}">{"".join(column(c) for c in range(i + 1))}</metadata>{side}{maps}</node>')"""


def _link(i: int, rich: bool) -> str:
    traces = f"""<elementParameter field="TABLE" name="TRACES"><elementValue elementRef="COLUMN" value="c0"/>\
<elementValue elementRef="CONDITION" value="c0 &gt; {i}"/><elementValue elementRef="COLUMN" value="c{i}"/>\
<elementValue elementRef="CONDITION" value=""/></elementParameter><elementParameter field="TEXT" name="UNIQUE_NAME" value="row{i}"/>"""
    end = f">{traces}</connection>" if rich else "/>"
    return f"""'<connection connectorName="FLOW" label="row{i}" source="n{i - 1}" target="n{i}"{end}'"""


def _job(rich: bool) -> str:
    def up_to_last(parts: dict[int, str]) -> str:
        return f"array_join(array({', '.join(f'IF(last >= {i}, {part}, NULL)' for i, part in parts.items())}), '')"

    return f"""IF(last IS NULL, NULL, concat('<?xml version="1.0" encoding="UTF-8"?><j:Job j:version="2.0" xmlns:j="http://example.org/job"><context name="Default"/>',
  {up_to_last({i: _node(i, rich) for i in range(4)})}, {up_to_last({i: _link(i, rich) for i in range(1, 4)})},
  CASE WHEN o_orderkey % 2 = 0 THEN concat('<connection connectorName="REJECT" label="bad" source="n0" target="n', last, '"/>') ELSE '' END,
  '</j:Job>'))"""


_XML = _job(rich=False)


def _files(rows: DataFrame, xml: str = _XML) -> DataFrame:
    jobs = spread(rows.withColumn("last", (F.col("o_orderkey") % 3 + 1).cast("int")))
    return jobs.select(F.col("o_orderkey").cast("string").alias("job"), F.expr(xml).alias("xml"))


def _jobs(spark: SparkSession, d: str, schema: str) -> DataFrame:
    return J.parse_jobs(_files(table(spark, d, "orders")), schema)


_NODES = """WITH jobs AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS job, o_orderkey, o_custkey, o_orderstatus,
           CAST(o_orderkey % 3 + 1 AS INTEGER) AS last FROM orders),
    nodes AS (SELECT *, 'n' || i AS unique_name FROM (
        SELECT *, CAST(unnest(range(0, last + 1)) AS INTEGER) AS i FROM jobs)),
    cols AS (SELECT *, CAST(unnest(range(0, i + 1)) AS INTEGER) AS c FROM nodes),
    edges AS (
        SELECT job, 'FLOW' AS connector, 'row' || i AS label, 'n' || (i - 1) AS source,
               'n' || i AS target FROM nodes WHERE i > 0
        UNION ALL SELECT job, 'REJECT', 'bad', 'n0', 'n' || last FROM jobs WHERE o_orderkey % 2 = 0)
"""


@query("job_components", _NODES + """SELECT job,
    CASE i WHEN 0 THEN 'reader' WHEN 1 THEN 'map' ELSE 'writer' END AS component_name, unique_name,
    '0.' || i AS version FROM nodes""")
def _job_components(spark, d):
    return J.components(_jobs(spark, d, J.COMPONENTS))


@query("job_parameters", _NODES + """
    SELECT job, unique_name, 'TEXT' AS field, 'UNIQUE_NAME' AS name, unique_name AS value FROM nodes
    UNION ALL SELECT job, unique_name, 'CLOSED_LIST', 'STATUS', o_orderstatus FROM nodes
    UNION ALL SELECT job, unique_name, 'TABLE', 'KEYS', NULL FROM nodes""")
def _job_parameters(spark, d):
    return J.parameters(_jobs(spark, d, J.PARAMETERS))


@query("job_table_parameters", _NODES + """SELECT job, unique_name, 'KEYS' AS name,
    CAST(c + 1 AS INTEGER) AS row, 'c' || c AS "column", CAST(c = 0 AS VARCHAR) AS key FROM cols""")
def _job_table_parameters(spark, d):
    rows = J.table_parameters(_jobs(spark, d, J.PARAMETERS))
    return rows.select("job", "unique_name", "name", "row", F.col("values.COLUMN").alias("column"),
                       F.col("values.KEY").alias("key"))


@query("job_connectors", _NODES + """
    SELECT job, unique_name, 'FLOW' AS connector, unique_name AS meta_name, i + 1 AS n_columns
    FROM nodes
    UNION ALL SELECT job, unique_name, CASE i WHEN 0 THEN 'REJECT' ELSE 'OTHER' END,
        CASE i WHEN 0 THEN 'REJECT' ELSE 'OTHER' END, CASE i WHEN 0 THEN 1 ELSE 0 END FROM nodes""")
def _job_connectors(spark, d):
    return J.connectors(_jobs(spark, d, J.CONNECTORS))


@query("job_columns", _NODES + """
    SELECT job, unique_name, 'FLOW' AS connector, CAST(c + 1 AS INTEGER) AS position,
           'c' || c AS "column", 'id_String' AS type, CASE WHEN c = 0 THEN i ELSE -1 END AS length,
           -1 AS precision, true AS nullable, c = 0 AS key FROM cols
    UNION ALL SELECT job, 'n0', 'REJECT', 1, 'errorCode', 'id_String', 255, 0, true, false
    FROM jobs""")
def _job_columns(spark, d):
    return J.columns(_jobs(spark, d, J.COLUMNS))


@query("job_links", _NODES + "SELECT * FROM edges")
def _job_links(spark, d):
    return J.links(_jobs(spark, d, J.LINKS))


@query("job_column_changes", _NODES + """
    SELECT job, 'row' || i AS label, unique_name AS target, 'c' || c AS "column",
        CASE WHEN c < i THEN 'id_String/' || (i - 1) || '/true' END AS before,
        'id_String/' || CASE WHEN c = 0 THEN i ELSE -1 END || '/true' AS after,
        CASE WHEN c = i THEN 'added' ELSE 'changed' END AS change
    FROM cols WHERE i > 0 AND (c = 0 OR c = i)
    UNION ALL SELECT job, 'bad', unique_name, 'c' || c, NULL,
        'id_String/' || CASE WHEN c = 0 THEN i ELSE -1 END || '/true', 'added'
    FROM cols WHERE i = last AND o_orderkey % 2 = 0
    UNION ALL SELECT job, 'bad', 'n' || last, 'errorCode', 'id_String/255/true', NULL, 'dropped'
    FROM jobs WHERE o_orderkey % 2 = 0""")
def _job_column_changes(spark, d):
    return J.column_changes(_jobs(spark, d, J.CHANGES))


@query("job_lineage", _NODES + """
    SELECT a.job, a.unique_name AS source, b.unique_name AS target,
        CASE WHEN a.i = 0 AND b.i = b.last AND a.o_orderkey % 2 = 0 THEN 1 ELSE b.i - a.i END
            AS distance
    FROM nodes a JOIN nodes b ON a.job = b.job AND a.i < b.i""")
def _job_lineage(spark, d):
    return J.lineage(_jobs(spark, d, J.LINEAGE))


@query("job_dangling", _NODES + """SELECT job, 'n0' AS unique_name, 'REJECT' AS connector
    FROM jobs WHERE o_orderkey % 2 <> 0""")
def _job_dangling(spark, d):
    return J.dangling_outputs(_jobs(spark, d, J.CHANGES))


@query("job_map_expressions", _NODES + """
    SELECT job, 'n1' AS unique_name, 'out' AS "table", 'a' AS "column",
        '(row.c0 <= ' || o_custkey || ') ? 1 : 2' AS expression, 'id_Integer' AS type FROM jobs
    UNION ALL SELECT job, 'n1', 'out', 'b', 'row.c0', 'id_String' FROM jobs
    UNION ALL SELECT job, 'n1', 'out', 'c',
        '(((row.c0 <= ' || o_custkey || ') ? 1 : 2) * 3) + 1', 'id_Integer' FROM jobs""")
def _job_map_expressions(spark, d):
    return J.map_expressions(_jobs(spark, d, J.MAP_EXPRESSIONS))


@query("job_census", _NODES + """
    SELECT CASE i WHEN 0 THEN 'reader' WHEN 1 THEN 'map' ELSE 'writer' END AS component_name,
        count(*) AS n_uses, count(DISTINCT job) AS n_jobs FROM nodes GROUP BY 1""")
def _job_census(spark, d):
    return J.census(_jobs(spark, d, J.COMPONENTS))


@query("job_files_read", _NODES.replace("FROM orders)", """FROM (SELECT s_suppkey AS o_orderkey,
        s_nationkey AS o_custkey, 'A' AS o_orderstatus FROM supplier))""") + """
    SELECT CASE i WHEN 0 THEN 'reader' WHEN 1 THEN 'map' ELSE 'writer' END AS component_name,
        count(*) AS n_uses, count(DISTINCT job) AS n_jobs FROM nodes GROUP BY 1""")
def _job_files_read(spark, d):
    """The census from files on disk, one job file per supplier."""
    rows = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("o_orderkey"), F.col("s_nationkey").alias("o_custkey"),
        F.lit("A").alias("o_orderstatus"))
    path = scratch_path(spark, "jobs")
    _files(rows).withColumnRenamed("xml", "value").write.options(**BY_TASKS).partitionBy("job").text(path)
    return J.census(J.parse_jobs(J.read_job_files(spark, path), J.COMPONENTS))


@query("schema_diff", """SELECT * FROM (VALUES ('SAL_RANGE', 'added'), ('DATE_TIMESTAMP', 'added'))
    AS t("column", change), (SELECT count(*) AS n_rows FROM orders)""")
def _schema_diff(spark, d):
    before = employees(spark, d)
    after = enrich(before, F.current_timestamp())
    diff = schema_diff(before.schema, after.schema)
    changes = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("change"))
                        for c, k in sorted(diff.items())])
    return (after.agg(F.count(F.lit(1)).alias("n_rows"))
            .select("n_rows", F.inline(changes)))


# The same jobs with what lookups, traces, patterns and keys say; the map reads its input unique and once.
_RICH = _job(rich=True)


def _rich_jobs(spark: SparkSession, d: str, schema: str) -> DataFrame:
    return J.parse_jobs(_files(table(spark, d, "orders"), _RICH), schema)


@query("job_link_parameters", _NODES + """
    SELECT job, 'row' || i AS label, 'TABLE' AS field, 'TRACES' AS name, NULL AS value FROM nodes WHERE i > 0
    UNION ALL SELECT job, 'row' || i, 'TEXT', 'UNIQUE_NAME', 'row' || i FROM nodes WHERE i > 0""")
def _job_link_parameters(spark, d):
    return J.link_parameters(_rich_jobs(spark, d, J.LINK_PARAMETERS))


@query("job_link_traces", _NODES + """
    SELECT job, 'row' || i AS label, 1::INT AS row, 'c0' AS "column", 'c0 > ' || i AS condition FROM nodes WHERE i > 0
    UNION ALL SELECT job, 'row' || i, 2, 'c' || i, '' FROM nodes WHERE i > 0""")
def _job_link_traces(spark, d):
    rows = J.link_table_parameters(_rich_jobs(spark, d, J.LINK_PARAMETERS)).filter("name = 'TRACES'")
    return rows.select("job", "label", "row", F.col("values.COLUMN").alias("column"), F.col("values.CONDITION").alias("condition"))


@query("job_map_inputs", _NODES + """
    SELECT job, 'n1' AS unique_name, 1::INT AS position, 'row' AS "table", 'UNIQUE_MATCH' AS matching_mode, 'LOAD_ONCE' AS lookup_mode FROM jobs
    UNION ALL SELECT job, 'n1', 2, 'look', NULL, NULL FROM jobs""")
def _job_map_inputs(spark, d):
    return J.map_inputs(_rich_jobs(spark, d, J.MAP_INPUTS))


@query("job_column_patterns", _NODES + """SELECT job, unique_name, 'FLOW' AS connector, 'c1' AS "column", 'p' || i AS pattern
    FROM nodes WHERE i >= 1""")
def _job_column_patterns(spark, d):
    return J.column_patterns(_rich_jobs(spark, d, J.PATTERNS))


@query("job_column_changes_whole", _NODES + """, shown AS (SELECT *, 'id_String/' || CASE WHEN c = 0 THEN i ELSE -1 END || '/true/' || i || '/' || (c = 0)
        || '/' || CASE WHEN c = 1 THEN 'p' || i ELSE '' END AS shape FROM cols)
    SELECT new.job, 'row' || new.i AS label, new.unique_name AS target, 'c' || new.c AS "column", old.shape AS before, new.shape AS after,
        CASE WHEN old.shape IS NULL THEN 'added' ELSE 'changed' END AS change
    FROM shown new LEFT JOIN shown old ON old.job = new.job AND old.i = new.i - 1 AND old.c = new.c WHERE new.i > 0""")
def _job_column_changes_whole(spark, d):
    """Precision differs along every link, so every column changes."""
    return J.column_changes(_rich_jobs(spark, d, J.CHANGES), J.WHOLE_SHAPE).filter("label <> 'bad'")
