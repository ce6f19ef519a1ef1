"""Lookup joins: by equal keys, by edit distance, by token overlap. One lookup row per main row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowmill.operators.dedupe import first_per_key
from rowmill.operators import nearness
from rowmill.operators.nearness import close_pairs, similar_by_minhash
from rowmill.operators.overlap import overlapping
from rowmill.operators.skew import (
    HOT_ROWS, MAX_BYTES, MAX_ROWS, fits_in_memory, join_unique)


def lookup(main: DataFrame, lk: DataFrame, on: Mapping[str, str], order_by: Sequence[str | Column],
           load: str = "shuffle", null_safe: bool = False, max_rows: int = MAX_ROWS,
           max_bytes: int = MAX_BYTES, share: float | None = None, rows: int = HOT_ROWS
           ) -> DataFrame:
    """Main rows with the columns of the first lookup row (by ``order_by``) that has the same key.

    ``on`` maps main columns to lookup columns. ``load="once"`` holds the lookup in the memory of
    every executor if a measurement says it fits, and joins by shuffle if not.
    """
    keys = {f"__lk_{i}": c for i, c in enumerate(on.values())}
    single = first_per_key(lk, list(on.values()), order_by)
    right = single.select(*[F.col(c).alias(k) for k, c in keys.items()],
                          *[F.col(c) for c in lk.columns if c not in on.values()])
    fits = load == "once" and fits_in_memory(lk, max_rows, max_bytes)
    return join_unique(main, right, list(on), list(keys), "left", null_safe, share, rows,
                       fits).drop(*keys)


def _values(df: DataFrame, col: str, name: str) -> DataFrame:
    return df.select(F.col(col).alias(name)).filter(F.col(name).isNotNull()).distinct()


def tokens(text: Column, ngram: int | None = None) -> Column:
    """Distinct words of a text, or its distinct character n-grams."""
    if ngram is None:
        return F.array_remove(F.array_distinct(F.split(text, r"\s+")), "")
    grams = F.transform(F.sequence(F.lit(1), F.length(text) - ngram + 1),
                        lambda i: F.substring(text, i, F.lit(ngram)))
    return F.when(F.length(text) >= ngram, F.array_distinct(grams)).otherwise(F.array(text))


def similar_pairs(left: DataFrame, right: DataFrame, left_col: str, right_col: str,
                  threshold: float, ngram: int | None = None, recall: float | None = None) -> DataFrame:
    """``(left_value, right_value, score)`` of all distinct values with enough common tokens.

    With ``recall`` pairs are found by MinHash instead, each with that chance or better, for sets whose tokens are all common.

    Exact prefix filter: with tokens ordered from rare to common, two sets of overlap t share a
    token among the first n - ceil(t n) + 1 of each, so common tokens rarely join anything. Sets go along with these tokens
    and are compared where they meet, at the first such token that both share. A set too large for that is compared later,
    if the tokens from the first shared one can still add up to the threshold.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie in (0, 1]")
    if recall is not None:
        return similar_by_minhash(left, right, left_col, right_col, threshold, tokens(F.col("value"), ngram), recall)
    both = (_values(left, left_col, "value").withColumn("side", F.lit("left"))
            .unionByName(_values(right, right_col, "value").withColumn("side", F.lit("right"))))
    sets = both.select("side", "value", tokens(F.col("value"), ngram).alias("words"))
    single = (sets.select("side", "value", F.explode_outer("words").alias("token"))
              .filter(F.col("token").isNotNull()))
    weight = (single.groupBy(F.col("token").alias("__token"))
              .agg(F.count(F.lit(1)).alias("weight")))
    # Spark takes the tokens of a text to be no more than the text, and would send them all to every task.
    ranked = (join_unique(single.hint("merge"), weight, ["token"], ["__token"], "inner")
              .groupBy("side", "value")
              .agg(F.sort_array(F.collect_list(F.struct("weight", "token"))).alias("ranked")))
    size = F.size("ranked")
    prefix = size - F.ceil(F.lit(threshold) * size - 1e-9).cast("int") + 1
    words = F.col("ranked.token")
    heads = ranked.select("side", "value", size.alias("size"), words.alias("words"),
                          F.posexplode(F.slice("ranked", F.lit(1), prefix)).alias("at", "head"))
    meeting = heads.filter(F.col("size") <= nearness.CARRIED).select(
        F.col("head.token").alias("key"), (F.col("side") == "right").alias("right"), F.array("value").alias("values"), "words",
        F.slice("words", F.lit(1), F.col("at")).alias("before"))
    return overlapping(meeting, threshold).unionByName(_large_pairs(sets, heads, threshold))


def _large_pairs(sets: DataFrame, heads: DataFrame, threshold: float) -> DataFrame:
    """The pairs of which one set or both do not go along with their keys."""
    # The other set of a pair has at least the threshold's share of its tokens.
    sized = F.col("size") > threshold * nearness.CARRIED - 1e-9
    heads = heads.filter(sized).select("side", "value", "head.token", "size", (F.col("size") - F.col("at")).alias("rest"))
    large = F.col("size") > nearness.CARRIED

    def heads_of(side: str, which: Column) -> DataFrame:
        names = {c: f"{side}_{c}" for c in ("value", "size", "rest")}
        return heads.filter((F.col("side") == side) & which).drop("side").withColumnsRenamed(names)

    def words_of(side: str) -> DataFrame:
        return sets.filter(F.col("side") == side).select(
            F.col("value").alias(f"{side}_value"), F.col("words").alias(f"{side}_words"))

    sizes = F.col("left_size") + F.col("right_size")
    needed = F.lit(threshold / (1 + threshold)) * sizes - 1e-9
    # All sides grow with the input, and the driver would build up each that is sent to all tasks: so they are merged.
    met = [heads_of("left", a).join(heads_of("right", b).hint("merge"), "token") for a, b in ((large, F.lit(True)), (~large, large))]
    pairs = (met[0].unionByName(met[1]).filter(F.least("left_rest", "right_rest") >= needed)
             .select("left_value", "right_value", "left_size", "right_size").distinct())
    shared = F.size(F.array_intersect("left_words", "right_words"))
    return (pairs.join(words_of("left").hint("merge"), "left_value").join(words_of("right").hint("merge"), "right_value")
            .filter(shared >= needed)
            .select("left_value", "right_value", (shared / (sizes - shared)).alias("score")))


def fuzzy_lookup(main: DataFrame, lk: DataFrame, main_col: str, lk_col: str,
                 order_by: Sequence[str | Column], levenshtein: int = 0, jaccard: float = 0.0,
                 ngram: int | None = None, recall: float | None = None) -> DataFrame:
    """Main rows with the lookup row of the closest value, null where none is close enough.

    Closest is the least edit distance or the highest token overlap; a tie goes to the value that
    sorts first. Thresholds of 0 mean an exact lookup; ``recall`` is that of ``similar_pairs``.
    """
    if not levenshtein and not jaccard:
        return lookup(main, lk, {main_col: lk_col}, order_by)
    if levenshtein and jaccard:
        raise ValueError("give one threshold, levenshtein or jaccard")
    if levenshtein:
        pairs = close_pairs(main, lk, main_col, lk_col, levenshtein)
        rank = F.struct(F.col("distance"), F.col("right_value"))
    else:
        pairs = similar_pairs(main, lk, main_col, lk_col, jaccard, ngram, recall)
        rank = F.struct(-F.col("score"), F.col("right_value"))
    best = (pairs.groupBy("left_value").agg(F.min(rank).alias("best"))
            .select(F.col("left_value").alias("__left"),
                    F.col("best.right_value").alias("__right")))
    single = first_per_key(lk, [lk_col], order_by)
    matched = best.join(single, best["__right"] == single[lk_col], "inner").drop("__right")
    return join_unique(main, matched, [main_col], ["__left"], "left").drop("__left")
