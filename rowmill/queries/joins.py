"""Lookup joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowmill.operators import lookup as L
from rowmill.queries import query
from rowmill.queries.fixtures import CUSTOMERS_WITH_NULLS, customers_with_nulls, table

_FIRST_CUSTOMER = f"""WITH {CUSTOMERS_WITH_NULLS}, picked AS (
    SELECT c_nationkey, c_custkey, c_name FROM (SELECT *, row_number() OVER (
        PARTITION BY c_nationkey ORDER BY c_custkey DESC) AS rn FROM customers_with_nulls)
    WHERE rn = 1)"""


def _by_nation(spark, d, **options):
    """Orders keyed by customer modulo 30: some nations have no customer, one key may be hot."""
    orders = table(spark, d, "orders").select(
        "o_orderkey", (F.col("o_custkey") % 30).cast("int").alias("nation"))
    people = customers_with_nulls(spark, d).select("c_nationkey", "c_custkey", "c_name")
    return L.lookup(orders, people, {"nation": "c_nationkey"}, [F.col("c_custkey").desc()], **options)


_LOOKUP = _FIRST_CUSTOMER + """SELECT o_orderkey, nation, c_custkey, c_name FROM (
    SELECT o_orderkey, CAST(o_custkey % 30 AS INTEGER) AS nation FROM orders)
    LEFT JOIN picked ON nation = c_nationkey"""


@query("lookup_unique", _LOOKUP)
def _lookup_unique(spark, d):
    return _by_nation(spark, d)


@query("lookup_unique_hot", _LOOKUP)
def _lookup_unique_hot(spark, d):
    return _by_nation(spark, d, share=0.04, rows=1)


@query("lookup_once", _LOOKUP)
def _lookup_once(spark, d):
    return _by_nation(spark, d, load="once")


@query("lookup_once_too_big", _LOOKUP)
def _lookup_once_too_big(spark, d):
    return _by_nation(spark, d, load="once", max_rows=10)


@query("lookup_null_safe", f"""WITH {CUSTOMERS_WITH_NULLS}, picked AS (
    SELECT c_nationkey AS nation, min(c_custkey) AS first_custkey FROM customers_with_nulls GROUP BY 1)
    SELECT c_custkey, c_nationkey, first_custkey FROM customers_with_nulls
    LEFT JOIN picked ON c_nationkey IS NOT DISTINCT FROM nation""")
def _lookup_null_safe(spark, d):
    rows = customers_with_nulls(spark, d).select("c_custkey", "c_nationkey")
    lk = rows.select(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("first_custkey"))
    return L.lookup(rows, lk, {"c_nationkey": "nation"}, ["first_custkey"], null_safe=True)


_TYPOS = """typos AS (SELECT p_partkey, CASE p_partkey % 4
    WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, 'i', 'y') WHEN 2 THEN p_name || 's'
    ELSE substring(p_name, 2) || 'xyz' END AS typed FROM part)"""


def _typos(spark, d):
    name, shape = F.col("p_name"), F.col("p_partkey") % 4
    return table(spark, d, "part").select("p_partkey", F.when(shape == 0, name)
                                          .when(shape == 1, F.replace(name, F.lit("i"), F.lit("y")))
                                          .when(shape == 2, F.concat(name, F.lit("s")))
                                          .otherwise(F.concat(F.substr(name, F.lit(2)), F.lit("xyz")))
                                          .alias("typed"))


@query("fuzzy_pairs_lev", f"""WITH {_TYPOS}
    SELECT typed AS left_value, p_name AS right_value,
           CAST(levenshtein(typed, p_name) AS INTEGER) AS distance
    FROM (SELECT DISTINCT typed FROM typos), (SELECT DISTINCT p_name FROM part)
    WHERE levenshtein(typed, p_name) <= 2""")
def _fuzzy_pairs_lev(spark, d):
    return L.close_pairs(_typos(spark, d), table(spark, d, "part"), "typed", "p_name", 2)


@query("fuzzy_lookup_lev", f"""WITH {_TYPOS}, pairs AS (
    SELECT typed, p_name, row_number() OVER (PARTITION BY typed
        ORDER BY levenshtein(typed, p_name), p_name) AS rn
    FROM (SELECT DISTINCT typed FROM typos), (SELECT DISTINCT p_name FROM part)
    WHERE levenshtein(typed, p_name) <= 2),
    lk AS (SELECT p_name, min(p_partkey) AS match_key FROM part GROUP BY p_name)
    SELECT t.p_partkey, t.typed, pairs.p_name AS match_name, match_key FROM typos t
    LEFT JOIN pairs ON t.typed = pairs.typed AND rn = 1 LEFT JOIN lk ON pairs.p_name = lk.p_name""")
def _fuzzy_lookup_lev(spark, d):
    lk = table(spark, d, "part").select(F.col("p_partkey").alias("match_key"),
                                        F.col("p_name").alias("match_name"))
    return L.fuzzy_lookup(_typos(spark, d), lk, "typed", "match_name", ["match_key"], levenshtein=2)


@query("fuzzy_pairs_jaccard", """WITH sets AS (
        SELECT DISTINCT url, list_distinct(list_transform(range(1, greatest(length(url) - 1, 2)),
            lambda i: substring(url, i, 3))) AS grams FROM pages),
    scored AS (SELECT a.url AS left_value, b.url AS right_value,
        len(list_intersect(a.grams, b.grams)) AS shared, len(a.grams) + len(b.grams) AS total
    FROM sets a, sets b)
    SELECT left_value, right_value, CAST(shared AS DOUBLE) / (total - shared) AS score FROM scored
    WHERE CAST(shared AS DOUBLE) / (total - shared) >= 0.6""")
def _fuzzy_pairs_jaccard(spark, d):
    pages = table(spark, d, "pages")
    return L.similar_pairs(pages, pages, "url", "url", 0.6, ngram=3)


@query("fuzzy_lookup_jaccard", f"""WITH {_TYPOS}, grams AS (
    SELECT DISTINCT p_name AS v, list_distinct(list_transform(range(1, length(p_name)),
        lambda i: substring(p_name, i, 2))) AS g FROM part),
    typed_grams AS (SELECT DISTINCT typed AS v, list_distinct(list_transform(
        range(1, length(typed)), lambda i: substring(typed, i, 2))) AS g FROM typos),
    pairs AS (SELECT t.v AS typed, g.v AS p_name,
        CAST(len(list_intersect(t.g, g.g)) AS DOUBLE)
        / (len(t.g) + len(g.g) - len(list_intersect(t.g, g.g))) AS score
    FROM typed_grams t, grams g),
    best AS (SELECT typed, p_name FROM (SELECT *, row_number() OVER (
        PARTITION BY typed ORDER BY score DESC, p_name) AS rn FROM pairs WHERE score >= 0.6)
        WHERE rn = 1),
    lk AS (SELECT p_name, min(p_partkey) AS match_key FROM part GROUP BY p_name)
    SELECT t.p_partkey, t.typed, best.p_name AS match_name, match_key FROM typos t
    LEFT JOIN best ON t.typed = best.typed LEFT JOIN lk ON best.p_name = lk.p_name""")
def _fuzzy_lookup_jaccard(spark, d):
    lk = table(spark, d, "part").select(F.col("p_partkey").alias("match_key"),
                                        F.col("p_name").alias("match_name"))
    return L.fuzzy_lookup(_typos(spark, d), lk, "typed", "match_name", ["match_key"], jaccard=0.6,
                          ngram=2)


@query("similar_minhash")
def _similar_minhash(spark, d):
    """The pairs of ``fuzzy_pairs_jaccard`` by MinHash; a test holds its recall against the exact rows."""
    pages = table(spark, d, "pages")
    return L.similar_pairs(pages, pages, "url", "url", 0.6, ngram=3, recall=0.97)


_EDITED = """edited AS (SELECT DISTINCT substring(url, 1, 12) || '~' || substring(url, 14, 5) || substring(url, 20, 3) || substring(url, 24) AS typed FROM pages)"""


@query("fuzzy_pairs_lev_urls", f"""WITH {_EDITED}, urls AS (SELECT DISTINCT url FROM pages WHERE url IS NOT NULL)
    SELECT typed AS left_value, url AS right_value, CAST(levenshtein(typed, url) AS INTEGER) AS distance
    FROM edited, urls WHERE levenshtein(typed, url) <= 3""")
def _fuzzy_pairs_lev_urls(spark, d):
    """Addresses with one character replaced and two left out, many of them with a long part in common."""
    pages = table(spark, d, "pages")
    typed = F.concat(F.substring("url", 1, 12), F.lit("~"), F.substring("url", 14, 5), F.substring("url", 20, 3), F.expr("substring(url, 24)"))
    return L.close_pairs(pages.select(typed.alias("typed")), pages, "typed", "url", 3)
