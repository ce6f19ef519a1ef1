"""Delimited files: written from whole tables into the shared folder, then read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rowmill.queries import query
from rowmill.queries.fixtures import table
from rowmill.session import scratch_path
from rowmill.sources import delimited as R, tables as S

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                       T.StructField("dept", T.StringType()), T.StructField("sal", T.IntegerType())])
HEAD = "id|name|dept|sal"
LINES_A_FILE = 1_000_000


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _people(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("dept"),
        F.floor("c_acctbal").cast("string").alias("sal"), F.col("c_custkey").alias("key"))


def _line(*cols: Column, sep: str = "|") -> Column:
    return F.concat_ws(sep, *cols)


def write_lines(lines: DataFrame, head: str | None = HEAD, foot: str | None = None, files: int | None = None,
          **options) -> str:
    """Write one column of lines; every file gets the head and foot lines as its own.

    A file is a part of the table, so a line counts as the first or last of its part by its place. A task sorts whole
    parts, so there are as many as keep them to ``LINES_A_FILE``, and three at least.
    """
    spark = lines.sparkSession
    path = scratch_path(spark, "delimited")
    named = lines.toDF("key", "line")
    files = files or max(3, -(-named.count() // LINES_A_FILE))
    part = F.pmod("key", F.lit(files))
    rows = named.select(part.alias("part"), F.lit(1).alias("place"), "key", "line")
    for place, text in ((0, head), (2, foot)):
        if text is not None:
            edge = named.select(part.alias("part")).distinct()
            rows = rows.unionByName(edge.select("part", F.lit(place).alias("place"),
                                                F.lit(0).cast("bigint").alias("key"),
                                                F.lit(text).alias("line")))
    writer = (rows.repartition(files, "part").sortWithinPartitions("part", "place", "key")
              .select("part", F.col("line").alias("value"))
              .write.partitionBy("part").options(**options))
    if "encoding" in options:
        writer.options(sep="\x01", quote="", escape="").csv(path)
    else:
        writer.text(path)
    return path


_CUSTOMERS = """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS dept,
    CAST(floor(c_acctbal) AS INTEGER) AS sal FROM customer"""


@query("scan", _CUSTOMERS)
def _scan(spark, d):
    """Padded fields and blank lines; one header line per file."""
    p = _people(spark, d)
    line = F.when(p.key % 10 == 0, _text(_line(p.id, p.name, p.dept, p.sal), "\n   ")).otherwise(
        _line(_text(" ", p.id), _text(p.name, "  "), _text(" ", p.dept, " "), _text(p.sal, "\r")))
    return R.read_delimited(spark, write_lines(p.select("key", line)), SCHEMA)


@query("scan_header_footer", _CUSTOMERS)
def _scan_header_footer(spark, d):
    p = _people(spark, d)
    path = write_lines(p.select("key", _line(p.id, p.name, p.dept, p.sal)), f"made by hand\n{HEAD}",
                 "total\nchecked\nend")
    return R.read_delimited(spark, path, SCHEMA, header=2, footer=3)


def _faulty(spark, d) -> str:
    p = _people(spark, d)
    line = (F.when(p.key % 5 == 0, _line(p.id, p.name, p.dept, F.lit("12x")))
            .when(p.key % 7 == 0, _line(p.id, p.name))
            .when(p.key % 11 == 0, _line(p.id, p.name, p.dept, p.sal, F.lit("more")))
            .otherwise(_line(p.id, p.name, p.dept, p.sal)))
    return write_lines(p.select("key", line))


@query("scan_main", _CUSTOMERS + """
    WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 AND c_custkey % 11 <> 0""")
def _scan_main(spark, d):
    return R.read_with_rejects(spark, _faulty(spark, d), SCHEMA, check_fields=True)["main"]


@query("scan_reject", """
    SELECT c_custkey AS id, c_name AS name,
        CASE WHEN c_custkey % 5 = 0 OR c_custkey % 7 <> 0 THEN c_mktsegment END AS dept,
        CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 7 <> 0
             THEN CAST(floor(c_acctbal) AS INTEGER) END AS sal,
        concat_ws('|', c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment || '|12x'
            WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment || '|' ||
                CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) || '|more' END) AS line,
        CASE WHEN c_custkey % 5 = 0 THEN 'TYPE' ELSE 'FIELDS' END AS "errorCode",
        CASE WHEN c_custkey % 5 = 0 THEN 'sal:type' ELSE 'expected 4 fields' END AS "errorMessage"
    FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 7 = 0 OR c_custkey % 11 = 0""")
def _scan_reject(spark, d):
    return R.read_with_rejects(spark, _faulty(spark, d), SCHEMA, check_fields=True)["reject"]


@query("scan_loose", """
    SELECT c_custkey AS id, c_name AS name,
        CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS dept,
        CASE WHEN c_custkey % 7 <> 0 THEN CAST(floor(c_acctbal) AS INTEGER) END AS sal
    FROM customer WHERE c_custkey % 5 <> 0""")
def _scan_loose(spark, d):
    """Field counts unchecked: short rows end in nulls, extra fields drop out."""
    return R.read_with_rejects(spark, _faulty(spark, d), SCHEMA)["main"]


@query("scan_quoted", """SELECT c_custkey AS id, c_name || '|"x"' AS name, c_mktsegment AS dept,
    CAST(floor(c_acctbal) AS INTEGER) AS sal FROM customer""")
def _scan_quoted(spark, d):
    p = _people(spark, d)
    line = _line(p.id, _text('"', p.name, '|""x"""'), p.dept, p.sal)
    return R.read_delimited(spark, write_lines(p.select("key", line)), SCHEMA, csv=True)


@query("scan_unquoted", """SELECT c_custkey AS id, '"' || c_name || '"' AS name,
    CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_mktsegment END AS dept,
    CAST(floor(c_acctbal) AS INTEGER) AS sal FROM customer""")
def _scan_unquoted(spark, d):
    """Quotes are plain characters unless asked for, and an empty field is empty text, not null."""
    p = _people(spark, d)
    dept = F.when(p.key % 2 == 0, F.lit("")).otherwise(p.dept)
    line = _line(p.id, _text('"', p.name, '"'), dept, p.sal)
    return R.read_delimited(spark, write_lines(p.select("key", line)), SCHEMA)


def _latin9(spark, d, header: int):
    """No writer knows the charset, so its byte for the euro goes out as ISO-8859-1's ¤."""
    p = _people(spark, d)
    name = F.translate(_text(p.name, " Café €"), "€", "¤")
    path = write_lines(p.select("key", _line(p.id, name, p.dept, p.sal)), HEAD if header else None,
                 encoding="ISO-8859-1")
    return R.read_delimited(spark, path, SCHEMA, encoding="ISO-8859-15", header=header)


_LATIN9 = _CUSTOMERS.replace("c_name AS name", "c_name || ' Café €' AS name")


@query("scan_latin9", _LATIN9)
def _scan_latin9(spark, d):
    return _latin9(spark, d, 1)


@query("scan_latin9_bare", _LATIN9)
def _scan_latin9_bare(spark, d):
    return _latin9(spark, d, 0)


@query("scan_numbers", _CUSTOMERS)
def _scan_numbers(spark, d):
    """Thousands separators in one column, hexadecimal keys in another."""
    p = _people(spark, d)
    sal = F.replace(F.format_number(p.sal.cast("int"), 0), F.lit(","), F.lit("."))
    line = _line(_text("0x", F.hex(p.id.cast("bigint"))), p.name, p.dept, sal)
    return R.read_delimited(spark, write_lines(p.select("key", line)), SCHEMA, thousands=".", decimal=",",
                            decode_cols=["id"])


@query("scan_trim_some", """SELECT c_custkey AS id, c_name AS name, ' ' || c_mktsegment AS dept,
    CAST(floor(c_acctbal) AS INTEGER) AS sal FROM customer""")
def _scan_trim_some(spark, d):
    p = _people(spark, d)
    line = _line(p.id, _text(" ", p.name), _text(" ", p.dept), p.sal)
    return R.read_delimited(spark, write_lines(p.select("key", line)), SCHEMA, trim_all=False,
                            trim_cols=["name"])


@query("scan_split_record", _CUSTOMERS + " UNION ALL " + _CUSTOMERS)
def _scan_split_record(spark, d):
    p = _people(spark, d)
    one = _line(p.id, p.name, p.dept, p.sal)
    return R.read_delimited(spark, write_lines(p.select("key", _text(one, "~~", one))), SCHEMA,
                            split_record="~~")


@query("scan_row_sep", _CUSTOMERS)
def _scan_row_sep(spark, d):
    p = _people(spark, d)
    path = write_lines(p.select("key", _line(p.id, p.name, p.dept, p.sal)), lineSep=";")
    return R.read_delimited(spark, path, SCHEMA, row_sep=";")


@query("scan_compressed", _CUSTOMERS)
def _scan_compressed(spark, d):
    p = _people(spark, d)
    path = write_lines(p.select("key", _line(p.id, p.name, p.dept, p.sal)), compression="gzip")
    return R.read_delimited(spark, path, SCHEMA)


_DATED = T.StructType([T.StructField("id", T.LongType()),
                       T.StructField("day", T.DateType(), True, {"pattern": "dd.MM.yyyy"})])


def _dated(spark, d) -> str:
    o = table(spark, d, "orders")
    day = F.when(o.o_orderkey % 9 == 0, F.lit("31.02.1999")).otherwise(
        F.date_format("o_orderdate", "dd.MM.yyyy"))
    return write_lines(o.select("o_orderkey", _line(o.o_orderkey.cast("string"), day)), "id|day")


@query("scan_dates", """SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day FROM orders
    WHERE o_orderkey % 9 <> 0""")
def _scan_dates(spark, d):
    return R.read_with_rejects(spark, _dated(spark, d), _DATED, check_date=True)["main"]


@query("scan_dates_loose", """SELECT o_orderkey AS id,
    CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders""")
def _scan_dates_loose(spark, d):
    return R.read_delimited(spark, _dated(spark, d), _DATED)


@query("scan_limit", "SELECT least(count(*), 100) AS n_rows FROM customer")
def _scan_limit(spark, d):
    """Which rows come is open, so their number is checked."""
    p = _people(spark, d)
    path = write_lines(p.select("key", _line(p.id, p.name, p.dept, p.sal)))
    return R.read_delimited(spark, path, SCHEMA, limit=100).agg(F.count(F.lit(1)).alias("n_rows"))


@query("scan_sample", "SELECT least(count(*), 10) AS n_rows, true AS all_known FROM customer")
def _scan_sample(spark, d):
    p = _people(spark, d)
    path = write_lines(p.select("key", _line(p.id, p.name, p.dept, p.sal)))
    picked = R.read_delimited(spark, path, SCHEMA, sample_n=10, seed=7)
    known = table(spark, d, "customer").select(F.col("c_custkey").alias("known"))
    return (picked.join(known, picked.id == known.known, "left")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.every(F.col("known").isNotNull()).alias("all_known")))


# --- named tables -------------------------------------------------------------------------------


@query("source_table", "SELECT * FROM nation")
def _source_table(spark, d):
    name = f"nation_{uuid.uuid4().hex}"
    nations = table(spark, d, "nation")
    nations.write.option("path", scratch_path(spark, "source")).saveAsTable(name)
    return S.source(spark, "default", name)


@query("csv_relation", """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment
    FROM customer""")
def _csv_relation(spark, d):
    path = scratch_path(spark, "csv")
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    rows.write.options(sep="|", header=True).csv(path)
    return S.read_csv(spark, path, sep="|")


@query("seed_table", "SELECT n_nationkey, n_name FROM nation")
def _seed_table(spark, d):
    path = scratch_path(spark, "seed")
    rows = table(spark, d, "nation").select("n_nationkey", "n_name")
    rows.write.option("header", True).csv(path)
    return S.seed(spark, path, f"seed_{uuid.uuid4().hex}", rows.schema)


@query("external_files", "SELECT c_custkey, c_name FROM customer")
def _external_files(spark, d):
    path = scratch_path(spark, "external")
    rows = table(spark, d, "customer").select("c_custkey", "c_name")
    rows.write.options(sep="|", header=True).csv(path)
    return S.external_table(spark, f"external_{uuid.uuid4().hex}", path, rows.schema)


@query("lossy_text", "SELECT p_name || '�' AS name, count(*) AS n FROM part GROUP BY 1")
def _lossy_text(spark, d):
    """Bytes that are no UTF-8 become the replacement character, one per bad byte."""
    raw = F.concat(F.encode("p_name", "UTF-8"), F.unhex(F.lit("FF"))).cast("string")
    names = table(spark, d, "part").select(F.make_valid_utf8(raw).alias("name"))
    return names.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query("lossy_files", "SELECT p_name || '\ufffd' AS text, count(*) AS n FROM part GROUP BY 1")
def _lossy_files(spark, d):
    """Files of bytes that are no UTF-8, one for each name, read whole by ``read_text_lossy``."""
    path = scratch_path(spark, "lossy")
    names = table(spark, d, "part").groupBy("p_name").agg(F.count(F.lit(1)).alias("n"))
    raw = F.concat(F.encode("p_name", "UTF-8"), F.unhex(F.lit("FF"))).cast("string")
    # A file a name: the text writer writes bytes as they are and ends the line, which is cut off again.
    names.select(F.md5("p_name").alias("file"), raw.alias("value")).write.partitionBy("file").text(path)
    read = S.read_text_lossy(spark, f"{path}/*/*.txt").select(F.regexp_replace("text", "\n$", "").alias("text"), F.regexp_extract("path", "file=([0-9a-f]+)", 1).alias("file"))
    return read.join(names.select(F.md5("p_name").alias("file"), "n"), "file").select("text", "n")
