"""Projections, filters and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from rowmill.functions import scalars as S
from rowmill.operators import blocks, project as P
from rowmill.queries import query
from rowmill.queries.fixtures import (
    CUSTOMERS_WITH_NULLS, RAW_LINES, RAW_PEOPLE, customers_with_nulls, raw_lines, raw_people, table)

_CHARS = "".join(S.WHITE_SPACE)


@query("band", f"""WITH {CUSTOMERS_WITH_NULLS}
    SELECT c_custkey, CASE WHEN c_acctbal <= 5500 THEN 'Low' WHEN c_acctbal > 6500 THEN 'High'
                           ELSE 'Medium' END AS sal_range FROM customers_with_nulls""")
def _band(spark, d):
    return customers_with_nulls(spark, d).select("c_custkey", S.band(F.col("c_acctbal"))
                                                 .alias("sal_range"))


@query("stamp", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp FROM events")
def _stamp(spark, d):
    return table(spark, d, "events").select("event_id", S.stamp(F.col("ts")).alias("stamp"))


@query("stamp_as_cast", """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, date_trunc('second', ts) AS loaded
    FROM events""")
def _stamp_as_cast(spark, d):
    second = F.date_trunc("second", F.col("ts"))
    return table(spark, d, "events").select(
        "event_id", second.cast("string").alias("stamp"), second.alias("loaded"))


@query("run_stamp")
def _run_stamp(spark, d):
    """The clock, so without SQL: one stamp for all rows of a run."""
    return table(spark, d, "customer").select(
        "c_custkey", S.stamp().alias("run_text"), F.current_timestamp().alias("run_at"))


@query("rename_project", """
    SELECT c_custkey AS employee_id, c_name AS employee_name, c_mktsegment AS department
    FROM customer""")
def _rename_project(spark, d):
    renamed = P.rename(table(spark, d, "customer"), {
        "c_custkey": "employee_id", "c_name": "employee_name", "c_mktsegment": "department"})
    return renamed.select("employee_id", "employee_name", "department")


@query("variables", """
    SELECT c_custkey AS id, c_name AS name,
           CASE WHEN c_acctbal <= 5500 THEN 'Low' WHEN c_acctbal > 6500 THEN 'High'
                ELSE 'Medium' END AS sal_range,
           upper(CASE WHEN c_acctbal <= 5500 THEN 'Low' WHEN c_acctbal > 6500 THEN 'High'
                ELSE 'Medium' END) AS loud FROM customer""")
def _variables(spark, d):
    return P.map_columns(
        table(spark, d, "customer"),
        {"id": "c_custkey", "name": "c_name", "sal_range": "v_band", "loud": "v_loud"},
        variables={"v_band": S.band(F.col("c_acctbal")), "v_loud": "upper(v_band)"})


@query("whole_row_plus", "SELECT *, c_acctbal * 2 AS double_bal FROM customer")
def _whole_row_plus(spark, d):
    return table(spark, d, "customer").withColumn("double_bal", F.col("c_acctbal") * 2)


@query("not_null_filter", f"""WITH {CUSTOMERS_WITH_NULLS} SELECT c_custkey, c_nationkey, c_acctbal
    FROM customers_with_nulls WHERE c_nationkey IS NOT NULL AND c_acctbal IS NOT NULL""")
def _not_null_filter(spark, d):
    return (P.require_not_null(customers_with_nulls(spark, d), ["c_nationkey", "c_acctbal"])
            .select("c_custkey", "c_nationkey", "c_acctbal"))


@query("castable_filter", f"""WITH {RAW_PEOPLE} SELECT * FROM raw_people
    WHERE TRY_CAST("SAL" AS INTEGER) IS NOT NULL AND TRY_CAST("NAME" AS VARCHAR) IS NOT NULL""")
def _castable_filter(spark, d):
    return P.require_castable(raw_people(spark, d), {"SAL": "int", "NAME": "string"})


@query("safe_cast", f"""WITH {RAW_PEOPLE}
    SELECT "ID", "NAME", TRY_CAST("SAL" AS INTEGER) AS sal_int, "BORN" FROM raw_people""")
def _safe_cast(spark, d):
    return raw_people(spark, d).select("ID", "NAME", S.typed(F.col("SAL"), "int").alias("sal_int"),
                                       "BORN")


@query("strict_cast", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def _strict_cast(spark, d):
    return table(spark, d, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("numeric_text", f"""WITH {RAW_PEOPLE}
    SELECT * FROM raw_people WHERE regexp_matches("SAL", '^[-+]?[0-9]+$')""")
def _numeric_text(spark, d):
    return raw_people(spark, d).filter(S.is_integer_text(F.col("SAL")))


@query("accepted_filter", """SELECT * FROM customer
    WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')""")
def _accepted_filter(spark, d):
    return table(spark, d, "customer").filter(~F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))


@query("length_filter", "SELECT doc_id, n_chars FROM documents WHERE length(text) > 255")
def _length_filter(spark, d):
    return (table(spark, d, "documents").filter(F.length("text") > 255)
            .select("doc_id", "n_chars"))


@query("no_rows", "SELECT c_custkey, c_name FROM customer WHERE 1 = 0")
def _no_rows(spark, d):
    return P.schema_only(table(spark, d, "customer").select("c_custkey", "c_name"))


@query("empty_relation", """
    SELECT c_custkey, c_name FROM customer
    UNION ALL SELECT CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR) WHERE 1 = 0""")
def _empty_relation(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_name")
    return P.union_all(rows, P.empty_like(spark, rows.schema))


@query("literal_rows", """
    SELECT c_custkey, weight FROM customer JOIN (VALUES ('BUILDING', 1), ('MACHINERY', 2))
    AS w(segment, weight) ON c_mktsegment = segment""")
def _literal_rows(spark, d):
    weights = P.from_rows(spark, [("BUILDING", 1), ("MACHINERY", 2)], "segment string, weight int")
    rows = table(spark, d, "customer")
    return rows.join(weights, rows.c_mktsegment == weights.segment).select("c_custkey", "weight")


@query("union_all", """SELECT c_name AS name, c_nationkey AS nation FROM customer
    UNION ALL SELECT s_name, s_nationkey FROM supplier""")
def _union_all(spark, d):
    return P.union_all(
        table(spark, d, "customer").selectExpr("c_name AS name", "c_nationkey AS nation"),
        table(spark, d, "supplier").selectExpr("s_name AS name", "s_nationkey AS nation"))


@query("split_line", f"""WITH {RAW_LINES}
    SELECT nullif(split_part(line, '|', 1), '') AS id, trim(split_part(line, '|', 2)) AS name,
           nullif(split_part(line, '|', 3), '') AS dept,
           nullif(split_part(line, '|', 4), '') AS extra FROM raw_lines""")
def _split_line(spark, d):
    parts = P.split_columns(raw_lines(spark, d), "line", "|", ["id", "name", "dept", "extra"],
                            key="id")
    return P.trim_text(parts)


@query("trim_text", f"""WITH {RAW_LINES}
    SELECT trim(split_part(line, '|', 2)) AS name, split_part(line, '|', 2) AS padded
    FROM raw_lines""")
def _trim_text(spark, d):
    names = raw_lines(spark, d).select(F.split_part("line", F.lit("|"), F.lit(2)).alias("name"))
    return P.trim_text(names.withColumn("padded", F.col("name")), ["name"])


@query("strip_text", f"""
    SELECT doc_id, trim(chr(10) || ' ' || text || chr(9) || chr(10), '{_CHARS}') AS text
    FROM documents""")
def _strip_text(spark, d):
    return table(spark, d, "documents").select("doc_id", S.strip(
        F.concat(F.lit("\n "), "text", F.lit("\t\n"))).alias("text"))


@query("empty_to_null", f"""WITH {RAW_PEOPLE}
    SELECT nullif("ID", '') AS "ID", nullif("NAME", '') AS "NAME", nullif("SAL", '') AS "SAL",
           nullif("BORN", '') AS "BORN" FROM raw_people""")
def _empty_to_null(spark, d):
    return P.null_empty_text(raw_people(spark, d))


@query("or_default", f"""WITH {RAW_PEOPLE}
    SELECT "ID", coalesce(nullif("NAME", ''), '(none)') AS name FROM raw_people""")
def _or_default(spark, d):
    return raw_people(spark, d).select("ID", S.or_default(F.col("NAME"), "(none)").alias("name"))


@query("cut_text", "SELECT c_custkey, substring(c_name, 1, 8) AS c_name FROM customer")
def _cut_text(spark, d):
    return P.cut_text(table(spark, d, "customer").select("c_custkey", "c_name"), {"c_name": 8})


@query("typed_null", "SELECT c_custkey, CAST(NULL AS INTEGER) AS sal FROM customer")
def _typed_null(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.lit(None).cast("int").alias("sal"))


@query("convert_to", f"""WITH {RAW_PEOPLE}
    SELECT TRY_CAST("ID" AS BIGINT) AS "ID", "NAME", TRY_CAST("SAL" AS INTEGER) AS "SAL"
    FROM raw_people""")
def _convert_to(spark, d):
    schema = T.StructType([T.StructField("ID", T.LongType()), T.StructField("NAME", T.StringType()),
                           T.StructField("SAL", T.IntegerType())])
    return P.convert_to(raw_people(spark, d).select("ID", "NAME", "SAL"), schema)


@query("trace", """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice > 100000 AND o_orderstatus = 'F'""")
def _trace(spark, d):
    return P.trace(table(spark, d, "orders"), ["o_orderkey", "o_totalprice"],
                   "o_totalprice > 100000 AND o_orderstatus = 'F'")


@query("number_separators", """
    SELECT c_custkey, CAST(round(c_acctbal * 1000) AS BIGINT) AS amount FROM customer""")
def _number_separators(spark, d):
    amount = F.round(F.col("c_acctbal") * 1000).cast("bigint")
    shown = F.translate(F.format_number(amount, 0), ",", ".")
    return table(spark, d, "customer").select(
        "c_custkey", S.plain_number(shown, ".", ",").cast("bigint").alias("amount"))


@query("decode_numbers", "SELECT p_partkey, p_partkey AS from_hex, p_partkey AS from_octal FROM part")
def _decode_numbers(spark, d):
    hexa = F.concat(F.lit("0x"), F.hex("p_partkey"))
    octal = F.concat(F.lit("0"), F.conv(F.col("p_partkey").cast("string"), 10, 8))
    return table(spark, d, "part").select(
        "p_partkey", S.decode_number(hexa).cast("bigint").alias("from_hex"),
        S.decode_number(octal).cast("bigint").alias("from_octal"))


@query("latin9_text", "SELECT p_partkey, p_name || ' €é' AS name FROM part")
def _latin9_text(spark, d):
    raw = F.concat(F.encode("p_name", "ISO-8859-1"), F.unhex(F.lit("20A4E9")))
    return table(spark, d, "part").select("p_partkey", S.from_latin9(raw).alias("name"))


@query("artifact_id", "SELECT doc_id, sha256(text) AS id FROM documents")
def _artifact_id(spark, d):
    return table(spark, d, "documents").select("doc_id", blocks.artifact_id(F.col("text"))
                                               .alias("id"))
