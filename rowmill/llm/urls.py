"""URL filter: host rules first, then a weighted vocabulary found by an Aho-Corasick automaton.

Host, path and rules are column expressions. Only the lower-cased urls go to Python, in Arrow batches;
a strict term weighs as much as the limit, a soft term one, each counted once a url.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STRICT = ("casino", "porn", "xxx", "viagra", "gambling", "escort", "malware", "phishing")
SOFT = ("adult", "ads", "bet", "bets", "cheap", "dating", "farm", "free", "loan", "pills", "poker",
        "spam", "track", "win")
SOFT_LIMIT = 2


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest (action, host, path prefix) that fits, as its text, and its action; null if none fits."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, name, prefix in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)
        rule, action = F.when(fits, name + prefix).otherwise(rule), F.when(fits, verdict).otherwise(action)
    return rule, action


def judge(df: DataFrame, rules: Sequence[tuple[str, str, str]] = (), strict: Sequence[str] = STRICT,
          soft: Sequence[str] = SOFT, soft_limit: int = SOFT_LIMIT, url: str = "url", key: str = "page_id") -> DataFrame:
    """key, host, path, rule, verdict, n_strict, n_soft of each row.

    A term counts where no ASCII letter or digit touches it on either side, in any part of the url. One
    strict term, or ``soft_limit`` different soft ones, block a url that no rule decides. A null url,
    and one without ``://``, has an empty host and path and no rule; its terms count all the same.
    Rows are independent; other columns, whatever their names, are not read.
    """
    weights = {**{t: (t, False) for t in soft}, **{t: (t, True) for t in strict}}
    schema = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("url", T.StringType()),
                           T.StructField("n_strict", T.LongType()), T.StructField("n_soft", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, value in weights.items():
            found.add_word(term, value)
        found.make_automaton()
        small = str.maketrans(UPPER, LOWER)
        word = frozenset(LOWER + "0123456789")
        for batch in batches:
            hits = []
            for text in batch.column("url").to_pylist():
                low, terms = (text or "").translate(small), set()
                for end, (term, is_strict) in found.iter(low) if weights else ():
                    start = end - len(term)
                    if (start < 0 or low[start] not in word) and (end + 1 == len(low) or low[end + 1] not in word):
                        terms.add((term, is_strict))
                n = sum(s for _, s in terms)
                hits.append((n, len(terms) - n))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("url"), pa.array([h[0] for h in hits], pa.int64()),
                 pa.array([h[1] for h in hits], pa.int64())], names=schema.names)

    hits = df.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url")).mapInArrow(run, schema)
    parts = hits.select("key", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "n_strict", "n_soft")
    rule, action = longest_rule(F.col("host"), F.col("path"), rules)
    own = F.when((F.col("n_strict") > 0) | (F.col("n_soft") >= soft_limit), "block").otherwise("allow")
    return parts.select(F.col("key").alias(key), "host", "path", rule.alias("rule"),
                        F.coalesce(action, own).alias("verdict"), "n_strict", "n_soft")
