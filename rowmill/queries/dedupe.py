"""Unique and duplicate rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowmill.operators import dedupe as D
from rowmill.queries import query
from rowmill.queries.fixtures import CUSTOMERS_WITH_NULLS, customers_with_nulls, table

ORDER = ["o_orderdate", "o_orderkey"]
_RANKED = """SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
    AS rn FROM orders"""
_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
# Low limits that send every key of the small tables down the path for hot keys.
ALL_HOT = {"share": 0.0, "rows": 1}


def _orders(spark, d, **options):
    return D.uniq(table(spark, d, "orders"), ["o_custkey"], ORDER, **options)


@query("uniq_first", f"SELECT {_ORDERS} FROM ({_RANKED}) WHERE rn = 1")
def _uniq_first(spark, d):
    return _orders(spark, d)["unique"]


@query("uniq_dup", f"SELECT {_ORDERS} FROM ({_RANKED}) WHERE rn > 1")
def _uniq_dup(spark, d):
    return _orders(spark, d)["duplicate"]


@query("uniq_dup_hot", f"SELECT {_ORDERS} FROM ({_RANKED}) WHERE rn > 1")
def _uniq_dup_hot(spark, d):
    return _orders(spark, d, **ALL_HOT, salts=3)["duplicate"]


@query("uniq_once", f"SELECT {_ORDERS} FROM ({_RANKED}) WHERE rn = 2")
def _uniq_once(spark, d):
    return _orders(spark, d, once=True)["duplicate"]


@query("uniq_tagged", f"""SELECT {_ORDERS}, CASE WHEN rn = 1 THEN 'unique' ELSE 'duplicate' END
    AS route FROM ({_RANKED})""")
def _uniq_tagged(spark, d):
    return D.tag_duplicates(table(spark, d, "orders"), ["o_custkey"], ORDER)


@query("first_three_per_key", f"SELECT {_ORDERS}, CAST(rn AS INTEGER) AS row_num FROM ({_RANKED}) WHERE rn <= 3")
def _first_three_per_key(spark, d):
    numbered = D.row_num(table(spark, d, "orders"), ["o_custkey"], ORDER)
    return numbered.filter(F.col("row_num") <= 3)


_MIXED = """SELECT p_partkey, CASE WHEN p_partkey % 2 = 1 THEN upper(p_name) ELSE p_name END AS name,
    p_brand FROM part"""


def _parts(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 2 == 1, F.upper("p_name"))
        .otherwise(F.col("p_name")).alias("name"), "p_brand")


def _nocase_sql(key: str, keep: str) -> str:
    return f"""SELECT p_partkey, name, p_brand FROM (SELECT *, row_number() OVER (
        PARTITION BY {key} ORDER BY p_partkey) AS rn FROM ({_MIXED})) WHERE rn {keep}"""


@query("uniq_nocase", _nocase_sql("lower(name)", "= 1"))
def _uniq_nocase(spark, d):
    return D.uniq(_parts(spark, d), ["name"], ["p_partkey"], {"name": False})["unique"]


@query("uniq_nocase_dup", _nocase_sql("lower(name)", "> 1"))
def _uniq_nocase_dup(spark, d):
    return D.uniq(_parts(spark, d), ["name"], ["p_partkey"], {"name": False})["duplicate"]


@query("uniq_case", _nocase_sql("name", "= 1"))
def _uniq_case(spark, d):
    return D.uniq(_parts(spark, d), ["name"], ["p_partkey"])["unique"]


_LINES = """l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
    l_tax, l_returnflag, l_linestatus, l_shipdate"""
_LINES_RANKED = f"""SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY
    l_linenumber, {_LINES}) AS rn FROM lineitem"""


@query("uniq_composite", f"SELECT {_LINES} FROM ({_LINES_RANKED}) WHERE rn = 1")
def _uniq_composite(spark, d):
    return D.uniq(table(spark, d, "lineitem"), ["l_orderkey", "l_suppkey"],
                  ["l_linenumber"])["unique"]


@query("uniq_composite_dup", f"SELECT {_LINES} FROM ({_LINES_RANKED}) WHERE rn > 1")
def _uniq_composite_dup(spark, d):
    return D.uniq(table(spark, d, "lineitem"), ["l_orderkey", "l_suppkey"],
                  ["l_linenumber"])["duplicate"]


def _null_keys_sql(keep: str) -> str:
    return f"""WITH {CUSTOMERS_WITH_NULLS} SELECT c_custkey, c_nationkey FROM (
        SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn
        FROM customers_with_nulls) WHERE rn {keep}"""


@query("uniq_null_keys", _null_keys_sql("= 1"))
def _uniq_null_keys(spark, d):
    rows = customers_with_nulls(spark, d).select("c_custkey", "c_nationkey")
    return D.uniq(rows, ["c_nationkey"], ["c_custkey"])["unique"]


@query("uniq_null_keys_dup", _null_keys_sql("> 1"))
def _uniq_null_keys_dup(spark, d):
    rows = customers_with_nulls(spark, d).select("c_custkey", "c_nationkey")
    return D.uniq(rows, ["c_nationkey"], ["c_custkey"], **ALL_HOT)["duplicate"]


@query("uniq_decimal_keys", """
    SELECT l_quantity AS quantity, min(l_orderkey) AS l_orderkey FROM lineitem GROUP BY l_quantity""")
def _uniq_decimal_keys(spark, d):
    """Equal numbers of different scale are one key once they share a type."""
    rows = table(spark, d, "lineitem")
    both = (rows.select(F.col("l_quantity").cast("decimal(10,1)").alias("quantity"), "l_orderkey")
            .union(rows.select(F.col("l_quantity").cast("decimal(12,4)"), "l_orderkey")))
    unique = D.uniq(both, ["quantity"], ["l_orderkey"])["unique"]
    return unique.select(F.col("quantity").cast("double").alias("quantity"), "l_orderkey")


@query("any_per_key", "SELECT DISTINCT o_custkey FROM orders")
def _any_per_key(spark, d):
    return D.any_per_key(table(spark, d, "orders"), ["o_custkey"]).select("o_custkey")
