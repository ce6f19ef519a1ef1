"""Schema compliance, data tests and summaries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F, types as T

from rowmill.functions.sqltests import register_tests
from rowmill.operators import checks as C, summary
from rowmill.operators.compliance import (
    ColumnRule, compliance, positional_rules, rules_from_schema, tag_compliance)
from rowmill.operators.dedupe import tag_duplicates
from rowmill.queries import query
from rowmill.queries.fixtures import (
    CUSTOMERS_WITH_NULLS, EMPLOYEES, RAW_PEOPLE, customers_with_nulls, employees, raw_people, table)

PEOPLE = [ColumnRule("ID", "bigint"), ColumnRule("NAME", "string", nullable=False, max_length=25),
          ColumnRule("SAL", "int", nullable=False, max_length=6),
          ColumnRule("BORN", "date", nullable=False, pattern="yyyy-MM-dd")]

_STRICT = r"""NOT (regexp_matches("BORN", '^\d{4}-\d{2}-\d{2}$') AND TRY_CAST("BORN" AS DATE) IS NOT NULL)"""
_LENIENT = """TRY_CAST("BORN" AS DATE) IS NULL"""
_FAST = r"""NOT regexp_matches("BORN", '^\d{4}-\d{2}-\d{2}$')"""


def _checked(date_test: str = _STRICT, long_name: str = """length("NAME") > 25""",
             empty: str = """coalesce("NAME", '') = ''""", columns: str = "*",
             source: str = RAW_PEOPLE) -> str:
    return f"""WITH {source}, coded AS (
        SELECT {columns}, CASE WHEN {date_test} THEN 2 ELSE 0 END AS e_born,
            CASE WHEN {empty} THEN 4 WHEN {long_name} THEN 8 ELSE 0 END AS e_name,
            CASE WHEN "SAL" IS NULL THEN 4
                 ELSE (CASE WHEN TRY_CAST("SAL" AS INTEGER) IS NULL THEN 2 ELSE 0 END)
                    + (CASE WHEN length("SAL") > 6 THEN 8 ELSE 0 END) END AS e_sal
        FROM raw_people),
    tagged AS (
        SELECT "ID", "NAME", "SAL", "BORN",
            CASE (e_born > 0)::INT + (e_name > 0)::INT + (e_sal > 0)::INT WHEN 0 THEN NULL
                 WHEN 1 THEN CAST(e_born + e_name + e_sal AS VARCHAR) ELSE '16' END AS "errorCode",
            nullif(concat_ws(';', CASE WHEN e_born > 0 THEN 'BORN:type' END,
                CASE e_name WHEN 4 THEN 'NAME:empty' WHEN 8 THEN 'NAME:length' END,
                CASE e_sal WHEN 2 THEN 'SAL:type' WHEN 4 THEN 'SAL:empty' WHEN 8 THEN 'SAL:length'
                    WHEN 10 THEN 'SAL:type+length' END), '') AS "errorMessage"
        FROM coded)"""


@query("compliance_pass", _checked() + """SELECT "ID", "NAME", "SAL", "BORN" FROM tagged
    WHERE "errorCode" IS NULL""")
def _compliance_pass(spark, d):
    return compliance(raw_people(spark, d), PEOPLE)["pass"]


@query("compliance_reject", _checked() + """SELECT * FROM tagged WHERE "errorCode" IS NOT NULL""")
def _compliance_reject(spark, d):
    return compliance(raw_people(spark, d), PEOPLE)["reject"]


@query("error_summary", _checked() + """SELECT "errorCode", count(*) AS n_rows FROM tagged
    WHERE "errorCode" IS NOT NULL GROUP BY "errorCode" """)
def _error_summary(spark, d):
    return summary.error_summary(compliance(raw_people(spark, d), PEOPLE)["reject"])


@query("compliance_substring", _checked(
    long_name="false", columns="""* REPLACE (substring("NAME", 1, 25) AS "NAME",
    substring("SAL", 1, 6) AS "SAL")""").replace('length("SAL") > 6', "false")
    + "SELECT * FROM tagged")
def _compliance_substring(spark, d):
    return tag_compliance(raw_people(spark, d), PEOPLE, substring=True)


@query("compliance_empty_kept", _checked(empty='"NAME" IS NULL') + "SELECT * FROM tagged")
def _compliance_empty_kept(spark, d):
    return tag_compliance(raw_people(spark, d), PEOPLE, empty_is_null=["SAL"])


@query("compliance_dates_lenient", _checked(_LENIENT) + "SELECT * FROM tagged")
def _compliance_dates_lenient(spark, d):
    return tag_compliance(raw_people(spark, d), PEOPLE, date_mode="lenient")


@query("compliance_dates_fast", _checked(_FAST) + "SELECT * FROM tagged")
def _compliance_dates_fast(spark, d):
    return tag_compliance(raw_people(spark, d), PEOPLE, date_mode="fast")


DECLARED = T.StructType([
    T.StructField("KEY", T.LongType()),
    T.StructField("LABEL", T.StringType(), False, {"length": 25}),
    T.StructField("PAY", T.IntegerType(), False, {"length": 6}),
    T.StructField("DAY", T.DateType(), False, {"pattern": "yyyy-MM-dd"})])


@query("compliance_positional", _checked() + "SELECT * FROM tagged")
def _compliance_positional(spark, d):
    rows = raw_people(spark, d)
    return tag_compliance(rows, positional_rules(rows, DECLARED))


@query("compliance_declared", _checked() + """SELECT "ID" AS "KEY", "NAME" AS "LABEL",
    "SAL" AS "PAY", "BORN" AS "DAY", "errorCode" FROM tagged""")
def _compliance_declared(spark, d):
    rows = raw_people(spark, d).toDF("KEY", "LABEL", "PAY", "DAY")
    return tag_compliance(rows, rules_from_schema(DECLARED)).drop("errorMessage")


@query("compliance_precision", """
    SELECT p_partkey, CASE WHEN regexp_matches(price, '\\.[0-9]*[1-9]$') AND
        length(regexp_extract(rtrim(price, '0'), '\\.([0-9]*)$', 1)) > 1 THEN '8' END AS "errorCode"
    FROM (SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS price FROM part)""")
def _compliance_precision(spark, d):
    rows = table(spark, d, "part").select(
        "p_partkey", F.col("p_retailprice").cast("decimal(12,2)").alias("price"))
    tagged = tag_compliance(rows, [ColumnRule("price", "decimal(12,2)", precision=1)])
    return tagged.select("p_partkey", "errorCode")


# --- data tests ---------------------------------------------------------------------------------


@query("test_not_null", f"""WITH {CUSTOMERS_WITH_NULLS}
    SELECT * FROM customers_with_nulls WHERE c_acctbal IS NULL""")
def _test_not_null(spark, d):
    return C.failing_rows(customers_with_nulls(spark, d), C.not_null("c_acctbal"))


@query("test_unique", "SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY 1 HAVING count(*) > 1")
def _test_unique(spark, d):
    return C.repeated_keys(table(spark, d, "orders"), ["o_custkey"])


@query("test_accepted", "SELECT * FROM events WHERE event_type NOT IN ('click', 'view', 'error')")
def _test_accepted(spark, d):
    return C.failing_rows(table(spark, d, "events"),
                          C.accepted("event_type", ["click", "view", "error"]))


@query("test_range", f"""WITH {CUSTOMERS_WITH_NULLS}
    SELECT * FROM customers_with_nulls WHERE c_acctbal < 0 OR c_acctbal > 9000""")
def _test_range(spark, d):
    return C.failing_rows(customers_with_nulls(spark, d), C.in_range("c_acctbal", 0, 9000))


@query("test_expression", f"""WITH {CUSTOMERS_WITH_NULLS}
    SELECT * FROM customers_with_nulls WHERE NOT (c_acctbal >= c_nationkey * 100)""")
def _test_expression(spark, d):
    return C.failing_rows(customers_with_nulls(spark, d), C.holds("c_acctbal >= c_nationkey * 100"))


@query("test_numeric", f"""WITH {RAW_PEOPLE}
    SELECT * FROM raw_people WHERE NOT regexp_matches("SAL", '^-?\\d+$')""")
def _test_numeric(spark, d):
    return C.failing_rows(raw_people(spark, d), C.is_numeric("SAL"))


@query("test_timestamp", """
    SELECT event_id, loaded FROM (SELECT event_id, CASE WHEN event_id % 3 = 0
        THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS loaded FROM events)
    WHERE NOT regexp_matches(loaded, '^\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}$')""")
def _test_timestamp(spark, d):
    rows = table(spark, d, "events").select("event_id", F.when(
        F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("loaded"))
    return C.failing_rows(rows, C.is_valid_timestamp("loaded"))


@query("test_length", "SELECT doc_id, n_chars FROM documents WHERE length(text) > 2000")
def _test_length(spark, d):
    return (C.failing_rows(table(spark, d, "documents"), C.at_most("text", 2000))
            .select("doc_id", "n_chars"))


_UNLABELLED = """FROM documents d WHERE NOT EXISTS (
    SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""


@query("test_relationships", f"SELECT doc_id, count(*) AS n_rows {_UNLABELLED} GROUP BY doc_id")
def _test_relationships(spark, d):
    return C.orphan_keys(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id", "doc_id")


@query("test_relationships_rows", f"SELECT doc_id, lang, n_chars {_UNLABELLED}")
def _test_relationships_rows(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return C.orphan_rows(rows, table(spark, d, "labels"), "doc_id", "doc_id")


@query("tests_summary", f"""WITH {CUSTOMERS_WITH_NULLS}, counted AS (
    SELECT 'not_null_bal' AS test, count(*) FILTER (WHERE c_acctbal IS NULL) AS failures
        FROM customers_with_nulls
    UNION ALL SELECT 'known_segment', count(*) FILTER (WHERE c_mktsegment NOT IN
        ('BUILDING', 'MACHINERY')) FROM customers_with_nulls
    UNION ALL SELECT 'bal_in_range', count(*) FILTER (WHERE c_acctbal < -99999 OR c_acctbal > 99999)
        FROM customers_with_nulls
    UNION ALL SELECT 'unique_nation', count(*) FROM (SELECT c_nationkey FROM customers_with_nulls
        WHERE c_nationkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'nation_exists', count(*) FROM (SELECT DISTINCT c_nationkey
        FROM customers_with_nulls WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier)))
    SELECT test, failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM counted""")
def _tests_summary(spark, d):
    rows = customers_with_nulls(spark, d)
    return C.run_tests(
        rows, {"not_null_bal": C.not_null("c_acctbal"),
               "known_segment": C.accepted("c_mktsegment", ["BUILDING", "MACHINERY"]),
               "bal_in_range": C.in_range("c_acctbal", -99999, 99999)},
        {"unique_nation": C.repeated_keys(rows, ["c_nationkey"]),
         "nation_exists": C.orphan_keys(rows, table(spark, d, "supplier"), "c_nationkey",
                                        "s_nationkey")})


# --- counts and ages ----------------------------------------------------------------------------


@query("route_counts", f"""WITH {EMPLOYEES}, ranked AS (
    SELECT row_number() OVER (PARTITION BY lower("NAME") ORDER BY "ID") AS rn FROM employees)
    SELECT CASE WHEN rn = 1 THEN 'unique' ELSE 'duplicate' END AS route, count(*) AS n_rows
    FROM ranked GROUP BY 1""")
def _route_counts(spark, d):
    return summary.route_counts(tag_duplicates(employees(spark, d), ["NAME"], ["ID"],
                                               {"NAME": False}))


AS_OF = datetime(2024, 2, 1)


@query("freshness", """SELECT newest, CAST(floor(date_diff('microsecond', newest, as_of) / 3.6e9)
        AS BIGINT) AS age_hours,
        CASE WHEN newest < as_of - INTERVAL 72 HOUR THEN 'error'
             WHEN newest < as_of - INTERVAL 24 HOUR THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT max(ts) AS newest, TIMESTAMP '2024-02-01 00:00:00' AS as_of FROM events)""")
def _freshness(spark, d):
    return summary.freshness(table(spark, d, "events"), "ts", F.lit(AS_OF))


def _by_sql(spark, d, test: str):
    """Failing rows of ``raw_people`` by a table function in SQL."""
    register_tests(spark)
    return spark.sql("SELECT people.* FROM {people} AS people, LATERAL " + test + " AS test WHERE test.failing", people=raw_people(spark, d))


@query("sql_is_numeric", f"""WITH {RAW_PEOPLE} SELECT * FROM raw_people WHERE NOT regexp_matches("SAL", '^-?\\d+$')""")
def _sql_is_numeric(spark, d):
    return _by_sql(spark, d, "is_numeric(people.SAL)")


@query("sql_is_valid_timestamp", f"""WITH {RAW_PEOPLE} SELECT * FROM raw_people
    WHERE NOT regexp_matches("BORN" || ' 08:30:00', '^\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}$')""")
def _sql_is_valid_timestamp(spark, d):
    return _by_sql(spark, d, "is_valid_timestamp(concat(people.BORN, ' 08:30:00'))")


@query("sql_accepted_values", """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderstatus NOT IN ('F', 'O')""")
def _sql_accepted_values(spark, d):
    register_tests(spark)
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return spark.sql("""SELECT o.* FROM {orders} AS o, LATERAL accepted_values(o.o_orderstatus, array('F', 'O')) AS test
        WHERE test.failing""", orders=orders)
