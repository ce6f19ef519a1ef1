"""Registered queries of the text operators, and their SQL where it can say the same."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.llm import (
    centroids, decontam, line_dedup, line_rules, manifest, packing, pseudonyms, quality, simhash, suffix_dedup, tokens, toxicity, urls)
from rowmill.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return add


URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/"))
_CASES = [(len(h) + len(p), v, h, p) for v, h, p in URL_RULES]
_RULE_SQL = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
                     for _, v, h, p in sorted(_CASES, reverse=True))
_VERDICT_SQL = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for _, v, h, p in _CASES)


def _counts(terms) -> str:
    return " + ".join(f"CAST(regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') AS BIGINT)" for t in terms)


_LOW = f"translate(coalesce(url, ''), '{urls.UPPER}', '{urls.LOWER}')"


@query("op4_url_filter", rf"""
WITH parts AS (SELECT page_id, {_LOW} AS low,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{urls.UPPER}', '{urls.LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
hits AS (SELECT *, {_counts(urls.STRICT)} AS n_strict, {_counts(urls.SOFT)} AS n_soft,
    CASE {_RULE_SQL} END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE rule {_VERDICT_SQL}
    ELSE CASE WHEN n_strict > 0 OR n_soft >= {urls.SOFT_LIMIT} THEN 'block' ELSE 'allow' END END AS verdict,
    n_strict, n_soft FROM hits""")
def _op4(spark, d):
    return urls.judge(table(spark, d, "pages"), URL_RULES)


_KEYED = """lines AS (SELECT doc_id, i, line, CASE WHEN length(k) >= 40 THEN k END AS k FROM (
    SELECT doc_id, i, line, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), '{u}', '{l}') AS k
    FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))))""".replace(
    "{u}", urls.UPPER).replace("{l}", urls.LOWER)


@query("op6_line_dedup", f"""
WITH {_KEYED},
common AS (SELECT k, max(doc_id) AS last FROM lines WHERE k IS NOT NULL GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT l.*, coalesce(c.last > l.doc_id, false) AS gone FROM lines l LEFT JOIN common c USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def _op6(spark, d):
    cleaned = line_dedup.dedup_lines(table(spark, d, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op7_simhash")
def _op7(spark, d):
    return simhash.near_duplicates(table(spark, d, "documents"))


@query("op8_token_counts")
def _op8(spark, d):
    counted = tokens.count_tokens(table(spark, d, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


@query("op9_packing")
def _op9(spark, d):
    return packing.pack(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))



@query("op10_line_quality")
def _op10(spark, d):
    cleaned = line_rules.clean_lines(table(spark, d, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          "base_failed", "kept", "n_lines_failed", F.round("lost", 6).alias("lost"))


@query("op5_decontamination")
def _op5(spark, d):
    return decontam.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"), whole=True)


@query("op3_toxicity")
def _op3(spark, d):
    scored = toxicity.score(table(spark, d, "documents"), table(spark, d, "labels"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


@query("op1_pseudonyms")
def _op1(spark, d):
    return pseudonyms.pseudonymize(table(spark, d, "documents").select("doc_id", "text"), key="key of the registered query")


@query("op2_suffix_dedup")
def _op2(spark, d):
    cleaned = suffix_dedup.remove_repeats(table(spark, d, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _cluster_rounds(k: int = 8, rounds: int = 10) -> str:
    """The rounds one after another; a floor by hand, since integer division cuts towards zero."""
    near = """SELECT v.*, c.cluster, list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i]))) AS away
        FROM v, c{n} c QUALIFY row_number() OVER (PARTITION BY v.row ORDER BY away, c.cluster) = 1"""
    parts = [f"""v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS row,
            list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: coalesce(isfinite(e), false))) = 64)""",
             f"""c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, vec_id, x) - 1 AS INTEGER) AS cluster, x FROM (
        SELECT *, sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM v ORDER BY h, vec_id, x LIMIT {k}))"""]
    for n in range(rounds):
        parts.append(f"""c{n + 1} AS MATERIALIZED (
        WITH sums AS (SELECT cluster, i, sum(x[i]) AS s, count(*) AS m FROM ({near.format(n=n)}), range(1, 65) t(i) GROUP BY ALL),
        means AS (SELECT cluster, list(CAST((s - ((s % m) + m) % m) // m AS BIGINT) ORDER BY i) AS x FROM sums GROUP BY cluster)
        SELECT c.cluster, coalesce(means.x, c.x) AS x FROM c{n} c LEFT JOIN means USING (cluster))""")
    parts.append(f"last AS MATERIALIZED ({near.format(n=rounds)})")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, l.cluster, CAST(away AS BIGINT) AS distance, CAST(sum(away) OVER (PARTITION BY l.cluster) AS BIGINT) AS cluster_inertia,
    CAST(sum(away) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM last l JOIN c{rounds} c ON c.cluster = l.cluster"""


@query("op11_centroid_clusters", _cluster_rounds())
def _op11(spark, d):
    found = centroids.cluster(table(spark, d, "embeddings"))
    digests = [(c, n, sum(found.inertia), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest())
               for c, (x, n) in enumerate(zip(found.centroids, found.inertia))]
    of_cluster = spark.createDataFrame(digests, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.assigned.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


_FIELD = "coalesce(CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"


def _leaf_sql(later: bool) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c="(n_chars + 1)" if later and c == "n_chars" else c) for c in manifest.FIELDS) + ")"


# The unsigned CRC-32 of the id's digits, one at a time: 4 or 8 bits of a byte by table or by eight halvings; here by halvings.
_CRC = """list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda r, i: xor(r >> 1, CASE WHEN r % 2 = 1 THEN 3988292384 ELSE 0 END)))"""


@query("op12_merkle_manifest", f"""
WITH RECURSIVE leaves AS MATERIALIZED (
    SELECT doc_id, coalesce('+' || lang, '') AS tree, {_leaf_sql(False)} AS leaf,
        CASE WHEN xor({_CRC}, 4294967295) % 7 = 0 THEN {_leaf_sql(True)} END AS later FROM documents),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
up(tree, level, pos, h, n) AS (
    SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM placed
    UNION ALL SELECT tree, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 1) // 2
    FROM up WHERE n > 1 GROUP BY tree, level, pos // 2),
subroots AS MATERIALIZED (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos FROM up WHERE n = 1),
over(level, pos, h, n) AS (
    SELECT 0, pos, subroot, count(*) OVER () FROM subroots
    UNION ALL SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 1) // 2
    FROM over WHERE n > 1 GROUP BY level, pos // 2),
high AS (SELECT max(level) AS high FROM up),
steps AS MATERIALIZED (
    SELECT p.doc_id, p.tree, p.pos, u.level, (p.pos >> u.level) % 2 AS side, s.h FROM placed p JOIN up u ON u.tree = p.tree AND u.pos = p.pos >> u.level AND u.n > 1
        LEFT JOIN up s ON s.tree = u.tree AND s.level = u.level AND s.pos = xor(u.pos, 1)
    UNION ALL SELECT p.doc_id, p.tree, p.pos, high + 1 + o.level, (r.pos >> o.level) % 2, s.h FROM placed p CROSS JOIN high JOIN subroots r ON r.tree = p.tree
        JOIN over o ON o.pos = r.pos >> o.level AND o.n > 1 LEFT JOIN over s ON s.level = o.level AND s.pos = xor(o.pos, 1)),
paths AS MATERIALIZED (SELECT tree, pos, list(struct_pack(side := side, h := coalesce(h, '')) ORDER BY level) AS path FROM steps GROUP BY tree, pos),
fold(tree, pos, step, h) AS (
    SELECT tree, pos, 0, coalesce(later, leaf) FROM placed
    UNION ALL SELECT f.tree, f.pos, step + 1, sha256(CASE WHEN path[step + 1].side = 1 THEN path[step + 1].h || f.h ELSE f.h || path[step + 1].h END)
    FROM fold f JOIN paths p ON p.tree = f.tree AND p.pos = f.pos WHERE step < len(path)),
top AS (SELECT h AS root FROM over WHERE n = 1),
ends AS (SELECT tree, pos, arg_max(h, step) AS folded_root FROM fold GROUP BY tree, pos)
SELECT p.doc_id, p.leaf, r.subroot, root,
    sha256(coalesce(array_to_string(list_transform(q.path, lambda s: s.h), ''), '')) AS proof_sha256, e.folded_root, e.folded_root = root AS verified
FROM placed p CROSS JOIN top JOIN subroots r ON r.tree = p.tree JOIN ends e ON e.tree = p.tree AND e.pos = p.pos LEFT JOIN paths q ON q.tree = p.tree AND q.pos = p.pos""")
def _op12(spark, d):
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    # One more than the largest long is a number too.
    chars = F.col("n_chars").cast("decimal(20,0)")
    made = manifest.manifest(table(spark, d, "documents"), changed={"n_chars": F.when(hit, chars + 1).otherwise(chars)})
    return made.drop("path")


@query("op13_quality")
def _op13(spark, d):
    scored = quality.score(table(spark, d, "documents"), table(spark, d, "labels"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "reasons")
