"""Catalogue of ETL job files: a table of ``(job, xml)`` in, component and link tables out.

Spark's XML function parses each file into one nested row; every table below is an explode of it, so
the catalogue of a large corpus shuffles only for the census. Parsing is the cost: to build
several tables, write ``parse_jobs`` to a table once and start from that; to build one, give
``parse_jobs`` the part of the schema that it reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Element and attribute names of the job file format.
_COLUMNS = """array<struct<_name:string, _type:string, _length:int, _precision:int,
  _nullable:boolean, _key:boolean, _pattern:string>>"""
_ENTRIES = "array<struct<_name:string, _expression:string, _type:string>>"
_TABLES = f"array<struct<_name:string, _matchingMode:string, _lookupMode:string, mapperTableEntries:{_ENTRIES}>>"
_PARAMETERS = """array<struct<_field:string, _name:string, _value:string,
    elementValue:array<struct<_elementRef:string, _value:string>>>>"""
_LINKS = f"""array<struct<_connectorName:string, _label:string, _metaname:string, _source:string,
  _target:string, elementParameter:{_PARAMETERS}>>"""
JOB_SCHEMA = f"""
node array<struct<
  _componentName:string, _componentVersion:string,
  elementParameter:{_PARAMETERS},
  metadata:array<struct<_connector:string, _name:string, column:{_COLUMNS}>>,
  nodeData:struct<varTables:{_TABLES}, outputTables:{_TABLES}, inputTables:{_TABLES}>>>,
connection {_LINKS}
"""
# What each table reads of a file, for tables that are built alone: the parser passes over all else.
_NAMED = "elementParameter:array<struct<_name:string, _value:string>>"
_ENDS = "connection array<struct<_connectorName:string, _label:string, _source:string, _target:string>>"
_DECLARING = f"{_NAMED}, metadata:array<struct<_connector:string, _name:string, column:{_COLUMNS}>>"
COMPONENTS = f"node array<struct<_componentName:string, _componentVersion:string, {_NAMED}>>"
PARAMETERS = f"node array<struct<elementParameter:{_PARAMETERS}>>"
CONNECTORS = f"node array<struct<{_NAMED}, metadata:array<struct<_connector:string, _name:string, column:array<struct<_name:string>>>>>>"
COLUMNS = f"node array<struct<{_DECLARING}>>"
PATTERNS = f"node array<struct<{_NAMED}, metadata:array<struct<_connector:string, column:array<struct<_name:string, _pattern:string>>>>>>"
LINKS, LINK_PARAMETERS = _ENDS, f"connection {_LINKS}"
LINEAGE = "connection array<struct<_source:string, _target:string>>"
CHANGES = f"{COLUMNS}, {_ENDS}"
MAP_INPUTS = f"node array<struct<{_NAMED}, nodeData:struct<inputTables:array<struct<_name:string, _matchingMode:string, _lookupMode:string>>>>>"
MAP_EXPRESSIONS = f"node array<struct<{_NAMED}, nodeData:struct<varTables:{_TABLES}, outputTables:{_TABLES}>>>"
UNIQUE_NAME = "UNIQUE_NAME"
FLOW = "FLOW"

_DECLARED = f"array<struct<component:string, connector:string, column:{_COLUMNS}>>"
_VARIABLES = "array<struct<ref:string, text:string>>"


def read_job_files(spark: SparkSession, path: str) -> DataFrame:
    """``(job, xml)``, one row per file."""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("job"), F.col("value").alias("xml")))


def parse_jobs(files: DataFrame, schema: str = JOB_SCHEMA) -> DataFrame:
    """``(job, node, connection)``, or those of the two that ``schema`` names; a file that is no job has neither."""
    parsed = F.from_xml(F.col("xml"), schema, {"ignoreSurroundingSpaces": "true"})
    return files.select("job", parsed.alias("doc")).select("job", "doc.*")


def _unique_name(node: Column) -> Column:
    named = F.filter(node["elementParameter"], lambda p: p["_name"] == UNIQUE_NAME)
    return F.get(named, 0)["_value"]


def _rows(jobs: DataFrame, array: Column | str, name: str, *others: Column | str) -> DataFrame:
    """One row per element. A plain explode would first filter on the array's size, and Spark would
    parse every file again for that filter."""
    rows = jobs.select("job", F.explode_outer(array).alias(name), *others)
    return rows.filter(F.col(name).isNotNull())


def _nodes(jobs: DataFrame) -> DataFrame:
    rows = _rows(jobs, "node", "node")
    return rows.select("job", _unique_name(F.col("node")).alias("unique_name"), "node")


def components(jobs: DataFrame) -> DataFrame:
    return _nodes(jobs).select("job", F.col("node._componentName").alias("component_name"),
                               "unique_name", F.col("node._componentVersion").alias("version"))


def parameters(jobs: DataFrame) -> DataFrame:
    """One row per component and parameter; repeated groups are in ``table_parameters``."""
    rows = _nodes(jobs).select("job", "unique_name",
                               F.explode("node.elementParameter").alias("p"))
    return rows.select("job", "unique_name", F.col("p._field").alias("field"),
                       F.col("p._name").alias("name"), F.col("p._value").alias("value"))


def table_parameters(jobs: DataFrame) -> DataFrame:
    """One row per group of a repeated parameter: ``values`` maps element name to value.

    The file holds a flat list; a group begins wherever the first element's name comes again.
    """
    return _groups(_nodes(jobs).select("job", "unique_name", F.explode("node.elementParameter").alias("p")))


def _groups(rows: DataFrame) -> DataFrame:
    """The groups of each parameter ``p`` that has elements."""
    known = [c for c in rows.columns if c != "p"]
    rows = rows.filter(F.size("p.elementValue") > 0).select(
        *known, F.col("p._name").alias("name"), F.col("p.elementValue").alias("flat"))
    places = F.filter(F.sequence(F.lit(0), F.size("flat") - 1),
                      lambda i: F.get("flat", i)["_elementRef"] == F.get("flat", 0)["_elementRef"])
    rows = rows.withColumn("starts", places)
    ends = F.concat(F.slice("starts", F.lit(2), F.size("starts")), F.array(F.size("flat")))
    rows = rows.select(*known, "name", "flat",
                       F.posexplode(F.arrays_zip("starts", ends.alias("ends")))
                       .alias("pos", "span"))
    group = F.slice("flat", F.col("span.starts") + 1, F.col("span.ends") - F.col("span.starts"))
    pairs = F.transform(group, lambda e: F.struct(e["_elementRef"], e["_value"]))
    return rows.select(*known, "name", (F.col("pos") + 1).alias("row"),
                       F.map_from_entries(pairs).alias("values"))


def connectors(jobs: DataFrame) -> DataFrame:
    """Declared outputs: one row per component and connector, with or without columns."""
    rows = _nodes(jobs).select("job", "unique_name", F.explode("node.metadata").alias("m"))
    return rows.select("job", "unique_name", F.col("m._connector").alias("connector"),
                       F.col("m._name").alias("meta_name"),
                       F.coalesce(F.size("m.column"), F.lit(0)).alias("n_columns"))


def columns(jobs: DataFrame) -> DataFrame:
    rows = _nodes(jobs).select("job", "unique_name", F.explode("node.metadata").alias("m"))
    rows = rows.select("job", "unique_name", "m._connector",
                       F.posexplode("m.column").alias("pos", "c"))
    return rows.select("job", "unique_name", F.col("_connector").alias("connector"),
                       (F.col("pos") + 1).alias("position"), F.col("c._name").alias("column"),
                       F.col("c._type").alias("type"), F.col("c._length").alias("length"),
                       F.col("c._precision").alias("precision"),
                       F.col("c._nullable").alias("nullable"), F.col("c._key").alias("key"))


def links(jobs: DataFrame) -> DataFrame:
    rows = _rows(jobs, "connection", "c")
    return rows.select("job", F.col("c._connectorName").alias("connector"),
                       F.col("c._label").alias("label"), F.col("c._source").alias("source"),
                       F.col("c._target").alias("target"))


def _link_parameters(jobs: DataFrame) -> DataFrame:
    rows = _rows(jobs, "connection", "c")
    return rows.select("job", F.col("c._label").alias("label"), F.explode_outer("c.elementParameter").alias("p")).filter(F.col("p").isNotNull())


def link_parameters(jobs: DataFrame) -> DataFrame:
    """One row per link and parameter; repeated groups are in ``link_table_parameters``."""
    return _link_parameters(jobs).select("job", "label", F.col("p._field").alias("field"), F.col("p._name").alias("name"),
                                         F.col("p._value").alias("value"))


def link_table_parameters(jobs: DataFrame) -> DataFrame:
    """One row per group of a link's repeated parameter, such as its trace settings: a column, whether it is shown, a condition."""
    return _groups(_link_parameters(jobs))


def map_inputs(jobs: DataFrame) -> DataFrame:
    """The inputs of maps, and how a lookup among them is matched and loaded (null where the file does not say)."""
    rows = _nodes(jobs).filter(F.col("node.nodeData").isNotNull())
    rows = rows.select("job", "unique_name", F.posexplode_outer("node.nodeData.inputTables").alias("pos", "t")).filter(F.col("t").isNotNull())
    return rows.select("job", "unique_name", (F.col("pos") + 1).alias("position"), F.col("t._name").alias("table"),
                       F.col("t._matchingMode").alias("matching_mode"), F.col("t._lookupMode").alias("lookup_mode"))


def column_patterns(jobs: DataFrame) -> DataFrame:
    """Columns with a pattern of their own, as dates have."""
    rows = _nodes(jobs).select("job", "unique_name", F.explode("node.metadata").alias("m"))
    rows = rows.select("job", "unique_name", "m._connector", F.explode("m.column").alias("c"))
    return rows.filter(F.coalesce(F.col("c._pattern"), F.lit("")) != "").select(
        "job", "unique_name", F.col("_connector").alias("connector"), F.col("c._name").alias("column"), F.col("c._pattern").alias("pattern"))


def _declared(node: Column) -> Column:
    """Every connector of a component with its columns, as one array."""
    return F.transform(node["metadata"],
                       lambda m: F.struct(_unique_name(node), m["_connector"], m["column"]))


def _all_declared() -> Column:
    """The connectors of all components of a job; a component may have none."""
    some = F.filter("node", lambda n: F.size(n["metadata"]) > 0)
    return F.flatten(F.transform(some, _declared)).cast(_DECLARED)


SHAPE = ("_type", "_length", "_nullable")
# All that a declared column says of itself.
WHOLE_SHAPE = (*SHAPE, "_precision", "_key", "_pattern")


def _shape(column: Column, parts: Sequence[str]) -> Column:
    parts = [F.coalesce(column[p].cast("string"), F.lit("")) for p in parts]
    return F.when(column.isNotNull(), F.concat_ws("/", *parts))


def column_changes(jobs: DataFrame, parts: Sequence[str] = SHAPE) -> DataFrame:
    """Columns added, dropped or changed between what a link carries and what its target passes on.

    A column changes if one of ``parts`` does; with ``WHOLE_SHAPE`` precision, key and pattern count too. The row of a job holds both ends of its links, so nothing is shuffled.
    """
    # Declared columns are gathered once per job; both ends of a link, and both forms of a column, are looked up once, inside
    # the row: what a filter or a branch asks of an explode's result is not worked out again.
    whole = jobs.select("job", "connection", _all_declared().alias("declared"))

    def ends_at(component: Column, connector: Column) -> Column:
        found = F.filter("declared", lambda d: (d["component"] == component) & (d["connector"] == connector))
        return F.get(found, F.lit(0))["column"]

    ends = F.transform("connection", lambda c: F.struct(
        c["_label"].alias("label"), c["_target"].alias("target"), ends_at(c["_source"], c["_connectorName"]).alias("old"),
        ends_at(c["_target"], F.lit(FLOW)).alias("new")))
    rows = _rows(whole, ends, "end").filter((F.size("end.old") > 0) & (F.size("end.new") > 0))
    names = F.array_union(F.transform("end.old", lambda c: c["_name"]), F.transform("end.new", lambda c: c["_name"]))

    def named(side: str, name: Column) -> Column:
        return F.get(F.filter(side, lambda c: c["_name"] == name), F.lit(0))

    forms = F.transform(names, lambda n: F.struct(n.alias("column"), named("end.old", n).alias("old"), named("end.new", n).alias("new")))
    rows = rows.select("job", "end.label", "end.target", F.explode_outer(forms).alias("c"))
    rows = rows.select("job", "label", "target", "c.column", _shape(F.col("c.old"), parts).alias("before"),
                       _shape(F.col("c.new"), parts).alias("after"))
    change = (F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "dropped")
              .when(F.col("before") != F.col("after"), "changed"))
    return rows.withColumn("change", change).filter(F.col("change").isNotNull())


def lineage(jobs: DataFrame) -> DataFrame:
    """``(job, source, target, distance)``: everything reachable, by its shortest path.

    A job's row holds all its links, so the closure is worked out within the row, without a shuffle: from each
    source the newest targets go one link further, round by round, and targets reached before are left out, so
    cycles end. A component that a cycle leads back to is reached from itself.
    """
    edges = F.array_distinct(F.transform(F.filter("connection", lambda c: c["_source"].isNotNull() & c["_target"].isNotNull()),
                                         lambda c: F.struct(c["_source"].alias("source"), c["_target"].alias("target"))))
    rows = jobs.select("job", edges.alias("edges"))
    rows = rows.select("job", "edges", F.explode_outer(F.array_distinct(F.col("edges.source"))).alias("source"))
    rows = rows.filter(F.col("source").isNotNull())
    # The next targets are worked out once and then used twice.
    onward = """transform(array(array_distinct(transform(
            filter(edges, e -> array_contains(acc.newest, e.source) AND NOT array_contains(acc.reached.target, e.target)), e -> e.target))),
        next -> named_struct('reached', concat(acc.reached, transform(next, t -> named_struct('target', t, 'distance', d))), 'newest', next))[0]"""
    reached = F.expr(f"""aggregate(sequence(1, size(array_distinct(edges.target))),
        named_struct('reached', CAST(array() AS array<struct<target:string,distance:int>>), 'newest', array(source)),
        (acc, d) -> IF(size(acc.newest) = 0, acc, {onward}), acc -> acc.reached)""")
    pairs = rows.select("job", "source", reached.alias("reached"))
    pairs = pairs.select("job", "source", F.explode_outer("reached").alias("r")).filter(F.col("r").isNotNull())
    return pairs.select("job", "source", "r.target", "r.distance")


def dangling_outputs(jobs: DataFrame) -> DataFrame:
    """Declared side outputs with columns that no link takes; the main flow may end anywhere."""
    rows = _rows(jobs, _all_declared(), "d",
                 F.coalesce("connection", F.array().cast(jobs.schema["connection"].dataType)).alias("connection"))
    taken = F.exists("connection", lambda c: (c["_source"] == F.col("d.component"))
                     & (c["_connectorName"] == F.col("d.connector")))
    rows = rows.filter((F.col("d.connector") != FLOW) & (F.size("d.column") > 0) & ~taken)
    return rows.select("job", F.col("d.component").alias("unique_name"), "d.connector")


def _substituted(expression: Column, variables: Column) -> Column:
    """Put the text of each variable in place of ``Table.name``, the last declared one first."""
    def put(text: Column, var: Column) -> Column:
        quoted = F.regexp_replace(var["text"], r"([\\$])", r"\\$1")
        inside = F.regexp_replace(text, F.concat(F.lit(r"\b\Q"), var["ref"], F.lit(r"\E\b")),
                                  F.concat(F.lit("("), quoted, F.lit(")")))
        return F.when(F.trim(text) == var["ref"], var["text"]).otherwise(inside)

    return F.aggregate(F.reverse(variables), expression, put)


def map_expressions(jobs: DataFrame) -> DataFrame:
    """One row per map output column: its expression, with variables replaced by their own."""
    rows = _nodes(jobs).filter(F.col("node.nodeData").isNotNull())
    variables = F.flatten(F.transform("node.nodeData.varTables", lambda t: F.transform(
        t["mapperTableEntries"], lambda e: F.struct(
            F.concat(t["_name"], F.lit("."), e["_name"]), F.trim(e["_expression"])))))
    rows = rows.select("job", "unique_name",
                       F.coalesce(variables.cast(_VARIABLES), F.array().cast(_VARIABLES))
                       .alias("vars"),
                       F.explode("node.nodeData.outputTables").alias("t"))
    rows = rows.select("job", "unique_name", "vars", F.col("t._name").alias("table"),
                       F.explode("t.mapperTableEntries").alias("e"))
    return rows.select("job", "unique_name", "table", F.col("e._name").alias("column"),
                       _substituted(F.trim("e._expression"), F.col("vars")).alias("expression"),
                       F.col("e._type").alias("type"))


def census(jobs: DataFrame) -> DataFrame:
    """Uses of each component kind and the jobs that use it."""
    per_job = (components(jobs).groupBy("component_name", "job")
               .agg(F.count(F.lit(1)).alias("n")))
    return (per_job.groupBy("component_name")
            .agg(F.sum("n").alias("n_uses"), F.count(F.lit(1)).alias("n_jobs")))
