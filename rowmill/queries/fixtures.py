"""Inputs the test tables lack, derived from whole tables row by row: in Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Rows whose costly work makes one task of moderate length.
ROWS_A_TASK = 50_000


def spread(df: DataFrame) -> DataFrame:
    """Small tables come as one file and so as one task; give each core a part of the costly work, and a task no more than
    ``ROWS_A_TASK`` rows of a large table, however many cores there are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(cores, -(-df.count() // ROWS_A_TASK))
    return df.repartition(parts) if df.rdd.getNumPartitions() < parts else df


def null_every(n: int, key: str, value: Column) -> Column:
    return F.when(F.col(key) % n != 0, value)


def customers_with_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").withColumns({
        "c_nationkey": null_every(7, "c_custkey", F.col("c_nationkey")),
        "c_acctbal": null_every(11, "c_custkey", F.col("c_acctbal"))})


CUSTOMERS_WITH_NULLS = """customers_with_nulls AS (
    SELECT c_custkey, c_name,
           CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey END AS c_nationkey,
           CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal END AS c_acctbal, c_mktsegment
    FROM customer)"""


def employees(spark: SparkSession, folder: str) -> DataFrame:
    """One employee per order: repeated names in two cases, padded, missing and empty values."""
    key, clerk = F.col("o_orderkey"), F.concat(F.lit("Clerk#"), F.col("o_custkey").cast("string"))
    return table(spark, folder, "orders").select(
        null_every(17, "o_orderkey", key.cast("string")).alias("ID"),
        F.when(key % 29 == 0, F.lit("")).when(key % 2 == 0, F.upper(clerk)).otherwise(clerk)
        .alias("NAME"),
        null_every(13, "o_orderkey", F.col("o_orderpriority")).alias("DEPT"),
        null_every(19, "o_orderkey", F.floor(F.col("o_totalprice") / 50).cast("int")).alias("SAL"),
        null_every(23, "o_orderkey", F.col("o_orderstatus")).alias("AGE"))


EMPLOYEES = """employees AS (
    SELECT CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS "ID",
           CASE WHEN o_orderkey % 29 = 0 THEN ''
                WHEN o_orderkey % 2 = 0 THEN upper('Clerk#' || CAST(o_custkey AS VARCHAR))
                ELSE 'Clerk#' || CAST(o_custkey AS VARCHAR) END AS "NAME",
           CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS "DEPT",
           CASE WHEN o_orderkey % 19 <> 0 THEN CAST(floor(o_totalprice / 50) AS INTEGER) END AS "SAL",
           CASE WHEN o_orderkey % 23 <> 0 THEN o_orderstatus END AS "AGE"
    FROM orders)"""


def raw_people(spark: SparkSession, folder: str) -> DataFrame:
    """Text rows to check: missing, empty and overlong names, wrong numbers and dates."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        null_every(5, "c_custkey", key.cast("string")).alias("ID"),
        F.when(key % 7 == 0, F.lit("")).when(key % 11 == 0, F.repeat("c_name", 2))
        .otherwise(F.col("c_name")).alias("NAME"),
        F.when(key % 13 == 0, F.lit("12x")).when(key % 17 == 0, F.lit(None).cast("string"))
        .when(key % 19 == 0, F.lit("123456789"))
        .otherwise(F.floor("c_acctbal").cast("string")).alias("SAL"),
        F.when(key % 23 == 0, F.lit("2024-13-01")).when(key % 29 == 0, F.lit("2024-1-5"))
        .otherwise(F.lit("2024-01-05")).alias("BORN"))


RAW_PEOPLE = """raw_people AS (
    SELECT CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS "ID",
           CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN repeat(c_name, 2)
                ELSE c_name END AS "NAME",
           CASE WHEN c_custkey % 13 = 0 THEN '12x' WHEN c_custkey % 17 = 0 THEN NULL
                WHEN c_custkey % 19 = 0 THEN '123456789'
                ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) END AS "SAL",
           CASE WHEN c_custkey % 23 = 0 THEN '2024-13-01' WHEN c_custkey % 29 = 0 THEN '2024-1-5'
                ELSE '2024-01-05' END AS "BORN"
    FROM customer)"""


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(F.concat_ws(
        "|", F.col("c_custkey").cast("string"), F.concat(F.lit("  "), "c_name", F.lit(" ")),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("")).otherwise(F.col("c_mktsegment")))
        .alias("line"))


RAW_LINES = """raw_lines AS (
    SELECT concat_ws('|', CAST(c_custkey AS VARCHAR), '  ' || c_name || ' ',
                     CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END) AS line
    FROM customer)"""


def customer_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that hit customers, new ones, and one key more than once: two per three customers."""
    c = table(spark, folder, "customer")
    key = F.col("c_custkey")
    return c.select(
        F.when(key % 3 == 0, key + 1).when(key % 3 == 2, key + 10_000_000).otherwise(key)
        .alias("c_custkey"),
        key.alias("seq"), F.concat("c_name", F.lit("*")).alias("c_name"),
        F.when(key % 5 != 0, F.col("c_acctbal") + 1).alias("c_acctbal"))


CUSTOMER_CHANGES = """customer_changes AS (
    SELECT CASE WHEN c_custkey % 3 = 0 THEN c_custkey + 1
                WHEN c_custkey % 3 = 2 THEN c_custkey + 10000000 ELSE c_custkey END AS c_custkey,
           c_custkey AS seq, c_name || '*' AS c_name,
           CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal + 1 END AS c_acctbal
    FROM customer)"""


def fenced_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Each whole document inside one of six shapes of fences."""
    body, shape = F.col("text"), F.col("doc_id") % 6

    def text(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    doc = F.col("doc_id").cast("string")
    return table(spark, folder, "documents").select(
        "doc_id",
        F.when(shape == 0, body)
        .when(shape == 1, text("A:\n```sql\n", body, "\n```\nEnd"))
        .when(shape == 2, text("```\n", body, "\n```"))
        .when(shape == 3, text("```sql\nselect 1\n```\n```sql\n", body, "\n```"))
        .when(shape == 4, text("```yaml\n", body, "\n```\nSee ", F.col("lang"), "\n```sql\nselect ",
                               doc, "\n```\n"))
        .otherwise(text("  ```bash\n", body, "\n  ```\n```sql\n\n```")).alias("text"))


_NL = "' || chr(10) || '"
FENCED_DOCUMENTS = f"""fenced_documents AS (
    SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN text
        WHEN 1 THEN 'A:{_NL}```sql{_NL}' || text || '{_NL}```{_NL}End'
        WHEN 2 THEN '```{_NL}' || text || '{_NL}```'
        WHEN 3 THEN '```sql{_NL}select 1{_NL}```{_NL}```sql{_NL}' || text || '{_NL}```'
        WHEN 4 THEN '```yaml{_NL}' || text || '{_NL}```{_NL}See ' || lang || '{_NL}```sql{_NL}select '
                    || CAST(doc_id AS VARCHAR) || '{_NL}```{_NL}'
        ELSE '  ```bash{_NL}' || text || '{_NL}  ```{_NL}```sql{_NL}{_NL}```' END AS text
    FROM documents)"""
