"""The whole flow and its layered form, over one employee per order."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from rowmill.operators.summary import flow_counts
from rowmill.plans import employee, models
from rowmill.queries import query
from rowmill.queries.fixtures import EMPLOYEES, employees
from rowmill.queries.files import write_lines
from rowmill.queries.writes import stored
from rowmill.sources.delimited import EMPLOYEE, read_delimited

RUN_AT = datetime(2024, 3, 1, 8, 30)
ORDER = ["ID", "DEPT", "SAL", "AGE"]

_BAND = """CASE WHEN "SAL" <= 5500 THEN 'Low' WHEN "SAL" > 6500 THEN 'High' ELSE 'Medium' END"""
_MISSING = """("NAME" IS NULL OR "NAME" = '')::INT AS b_name, ("DEPT" IS NULL OR "DEPT" = '')::INT
    AS b_dept, ("SAL" IS NULL)::INT AS b_sal, ("AGE" IS NULL OR "AGE" = '')::INT AS b_age"""
_FLOW = f"""WITH {EMPLOYEES}, ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lower("NAME") ORDER BY "ID" NULLS FIRST,
        "DEPT" NULLS FIRST, "SAL" NULLS FIRST, "AGE" NULLS FIRST, "NAME" NULLS FIRST) AS rn
    FROM employees),
    mapped AS (SELECT "ID", "NAME", "DEPT", "SAL", "AGE", {_BAND} AS "SAL_RANGE",
        '2024-03-01 08:30:00' AS "DATE_TIMESTAMP", {_MISSING} FROM ranked WHERE rn = 1),
    passed AS (SELECT "ID", "NAME", "DEPT", "SAL", "AGE", "SAL_RANGE", "DATE_TIMESTAMP" FROM mapped
        WHERE b_name + b_dept + b_sal + b_age = 0),
    rejected AS (SELECT "ID", "NAME", "DEPT", "SAL", "AGE", "SAL_RANGE", "DATE_TIMESTAMP",
        CASE WHEN b_name + b_dept + b_sal + b_age = 1 THEN '4' ELSE '16' END AS "errorCode",
        concat_ws(';', CASE WHEN b_age = 1 THEN 'AGE:empty' END,
            CASE WHEN b_dept = 1 THEN 'DEPT:empty' END, CASE WHEN b_name = 1 THEN 'NAME:empty' END,
            CASE WHEN b_sal = 1 THEN 'SAL:empty' END) AS "errorMessage"
        FROM mapped WHERE b_name + b_dept + b_sal + b_age > 0),
    repeated AS (SELECT "ID", "NAME", "DEPT", "SAL", "AGE" FROM ranked WHERE rn > 1)
"""


def _flow(spark, d):
    return employee.flow(employees(spark, d), RUN_AT, ORDER)


@query("flow_pass", _FLOW + "SELECT * FROM passed")
def _flow_pass(spark, d):
    return _flow(spark, d)["pass"]


@query("flow_reject", _FLOW + "SELECT * FROM rejected")
def _flow_reject(spark, d):
    return _flow(spark, d)["reject"]


@query("flow_duplicate", _FLOW + "SELECT * FROM repeated")
def _flow_duplicate(spark, d):
    return _flow(spark, d)["duplicate"]


@query("flow_counts", _FLOW + """SELECT 'unique' AS link, count(*) AS n_rows FROM mapped
    UNION ALL SELECT 'duplicate', count(*) FROM repeated
    UNION ALL SELECT 'mapped', count(*) FROM mapped
    UNION ALL SELECT 'pass', count(*) FROM passed
    UNION ALL SELECT 'reject', count(*) FROM rejected""")
def _flow_counts(spark, d):
    return employee.link_counts(employees(spark, d), RUN_AT, ORDER)


@query("flow_counts_by_link", _FLOW + """SELECT 'duplicate' AS link, count(*) AS n_rows FROM repeated
    UNION ALL SELECT 'reject', count(*) FROM rejected""")
def _flow_counts_by_link(spark, d):
    links = _flow(spark, d)
    return flow_counts({link: links[link] for link in ("duplicate", "reject")})


@query("flow_counts_of_all_links", _FLOW + """SELECT 'unique' AS link, count(*) AS n_rows FROM mapped
    UNION ALL SELECT 'duplicate', count(*) FROM repeated
    UNION ALL SELECT 'mapped', count(*) FROM mapped
    UNION ALL SELECT 'pass', count(*) FROM passed
    UNION ALL SELECT 'reject', count(*) FROM rejected""")
def _flow_counts_of_all_links(spark, d):
    """Each link counted as a plan of its own."""
    return flow_counts(_flow(spark, d))


@query("flow_written", _FLOW + """
    SELECT 'clean' AS kind, "ID", "DEPT", "SAL_RANGE", "DATE_TIMESTAMP" FROM passed
        WHERE "ID" IS NOT NULL
    UNION ALL SELECT 'untouched', "ID", NULL, 'old', NULL FROM employees WHERE "ID" IS NOT NULL
        AND "ID" NOT IN (SELECT "ID" FROM passed WHERE "ID" IS NOT NULL)
    UNION ALL SELECT 'duplicate', "ID", "DEPT", NULL, NULL FROM repeated
    UNION ALL SELECT 'reject', "ID", "DEPT", "SAL_RANGE", "errorCode" FROM rejected""")
def _flow_written(spark, d):
    """All three tables after a run whose update table holds every employee with an id."""
    people = employees(spark, d)
    held = people.filter(F.col("ID").isNotNull()).select(
        "ID", *[F.lit(None).cast(people.schema[c].dataType).alias(c) for c in people.columns[1:]],
        F.lit("old").alias("SAL_RANGE"), F.lit(None).cast("string").alias("DATE_TIMESTAMP"))
    clean, extra = stored(held, "clean"), stored(people.limit(0), "duplicate")
    shape = employee.flow(people, RUN_AT, ORDER)["reject"]
    wrong = stored(shape.withColumns({"source": F.lit(""), "run": F.lit("")}).limit(0), "reject")
    employee.run(spark, people, RUN_AT, clean, extra, wrong, ["ID"], ORDER)
    null = F.lit(None).cast("string")
    kind = F.when(F.col("SAL_RANGE") == "old", "untouched").otherwise("clean").alias("kind")
    return (spark.table(clean).select(kind, "ID", "DEPT", "SAL_RANGE", "DATE_TIMESTAMP")
            .union(spark.table(extra).select(F.lit("duplicate"), "ID", "DEPT", null, null))
            .union(spark.table(wrong).select(F.lit("reject"), "ID", "DEPT", "SAL_RANGE",
                                             "errorCode")))


@query("flow_written_twice", _FLOW + """
    SELECT 'clean' AS kind, *, NULL AS "errorCode", NULL AS "errorMessage", NULL AS run FROM passed WHERE "ID" IS NOT NULL
    UNION ALL SELECT 'untouched', "ID", NULL, NULL, NULL, NULL, 'old', NULL, NULL, NULL, NULL FROM employees WHERE "ID" IS NOT NULL
        AND "ID" NOT IN (SELECT "ID" FROM passed WHERE "ID" IS NOT NULL)
    UNION ALL SELECT 'duplicate', *, NULL, NULL, NULL, NULL, '2024-03-01T08:30:00' FROM repeated
    UNION ALL SELECT 'reject', *, '2024-03-01T08:30:00' FROM rejected""")
def _flow_written_twice(spark, d):
    """All columns of all three tables after one run that was started twice."""
    people = employees(spark, d)
    held = people.filter(F.col("ID").isNotNull()).select(
        "ID", *[F.lit(None).cast(people.schema[c].dataType).alias(c) for c in people.columns[1:]],
        F.lit("old").alias("SAL_RANGE"), F.lit(None).cast("string").alias("DATE_TIMESTAMP"))
    clean, extra = stored(held, "clean"), stored(people.withColumn("run", F.lit("")).limit(0), "duplicate", ["run"])
    shape = employee.flow(people, RUN_AT, ORDER)["reject"].withColumns({"source": F.lit(""), "run": F.lit("")})
    wrong = stored(shape.limit(0), "reject", ["source", "run"])
    for _ in range(2):
        employee.run(spark, people, RUN_AT, clean, extra, wrong, ["ID"], ORDER)
    kind = F.when(F.col("SAL_RANGE") == "old", "untouched").otherwise("clean")
    parts = [spark.table(clean).withColumn("kind", kind), spark.table(extra).withColumn("kind", F.lit("duplicate")),
             spark.table(wrong).drop("source").withColumn("kind", F.lit("reject"))]
    return parts[2].unionByName(parts[0], True).unionByName(parts[1], True)


_TEXT_FLOW = _FLOW.replace("FROM employees)", """FROM (SELECT coalesce("ID", '') AS "ID", "NAME",
        coalesce("DEPT", '') AS "DEPT", "SAL", coalesce("AGE", '') AS "AGE" FROM employees))""")


@query("flow_from_file", _TEXT_FLOW + """
    SELECT *, NULL AS "errorCode", NULL AS "errorMessage" FROM passed
    UNION ALL SELECT * FROM rejected""")
def _flow_from_file(spark, d):
    """The flow from its delimited file on; a null is an empty field there, and empty text after."""
    people = employees(spark, d)
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in people.columns]
    path = write_lines(people.select(F.xxhash64(*people.columns), F.concat_ws("|", *cells)),
                       "|".join(people.columns))
    links = employee.flow(read_delimited(spark, path, EMPLOYEE), RUN_AT, ORDER)
    return links["pass"].unionByName(links["reject"], allowMissingColumns=True)


_MODELS = f"""WITH {EMPLOYEES}, staged AS (
    SELECT trim("ID") AS employee_id, trim("NAME") AS employee_name, trim("DEPT") AS department,
           "SAL" AS salary, trim("AGE") AS age FROM employees),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY employee_name
        ORDER BY employee_id NULLS FIRST, employee_name NULLS FIRST, department NULLS FIRST,
        salary NULLS FIRST, age NULLS FIRST) AS rn FROM staged)"""


def _models(spark, d):
    raw = employees(spark, d)
    return models.split(models.staging(raw))


@query("models_final", _MODELS + """SELECT employee_id, employee_name, department, salary, age,
        CASE WHEN salary <= 5500 THEN 'Low' WHEN salary > 6500 THEN 'High' ELSE 'Medium' END
            AS salary_range, '2024-03-01 08:30:00' AS date_timestamp
    FROM ranked WHERE rn = 1 AND employee_id IS NOT NULL AND employee_name IS NOT NULL
        AND department IS NOT NULL AND salary IS NOT NULL AND age IS NOT NULL""")
def _models_final(spark, d):
    return models.validated(models.transformed(_models(spark, d)["unique"], RUN_AT))


@query("models_duplicates", _MODELS + """SELECT employee_id, employee_name, department, salary, age
    FROM ranked WHERE rn > 1""")
def _models_duplicates(spark, d):
    return _models(spark, d)["duplicate"]


@query("models_built", _MODELS + """SELECT 'final' AS model, count(*) AS n_rows FROM ranked
        WHERE rn = 1 AND employee_id IS NOT NULL AND employee_name IS NOT NULL
        AND department IS NOT NULL AND salary IS NOT NULL AND age IS NOT NULL
    UNION ALL SELECT 'duplicates', count(*) FROM ranked WHERE rn > 1""")
def _models_built(spark, d):
    """The same models registered as views and written as tables."""
    built = models.build(employees(spark, d), RUN_AT, f"m{uuid.uuid4().hex}")
    return flow_counts(built).withColumnRenamed("link", "model")


@query("models_contents", _MODELS + """
    SELECT 'final' AS model, employee_id, employee_name, department, salary, age,
        CASE WHEN salary <= 5500 THEN 'Low' WHEN salary > 6500 THEN 'High' ELSE 'Medium' END AS salary_range
    FROM ranked WHERE rn = 1 AND employee_id IS NOT NULL AND employee_name IS NOT NULL
        AND department IS NOT NULL AND salary IS NOT NULL AND age IS NOT NULL
    UNION ALL SELECT 'duplicates', employee_id, employee_name, department, salary, age, NULL FROM ranked WHERE rn > 1""")
def _models_contents(spark, d):
    """All rows of both tables that the models are written as."""
    built = models.build(employees(spark, d), RUN_AT, f"m{uuid.uuid4().hex}")
    final = built["final"].drop("date_timestamp").withColumn("model", F.lit("final"))
    return final.unionByName(built["duplicates"].withColumn("model", F.lit("duplicates")), allowMissingColumns=True)
