"""Pairs of close values without pairing off a block: by edit distance (exact) and by MinHash (measured recall).

Both work on distinct values, and meet through keys: only values with a common key are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rowmill.operators.overlap import overlapping

CROWD, ROUNDS, HASHES = 1_000, 3, 128
# Texts up to this length and sets up to this size go along with their keys.
CARRIED = 500
# Rows that values of one set make at most; the set is compared once for each.
SHARES = 8


def values_of(df: DataFrame, col: str) -> DataFrame:
    """``(id, value)`` of the distinct values; the id is a 128-bit hash.

    Keys are costly to make and short values few bytes, so values are dealt to a set number of tasks: merged by their bytes
    they would be one.
    """
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    values = df.select(F.col(f"`{col}`").alias("value")).filter(F.col("value").isNotNull()).repartition(parts, "value").distinct()
    return values.select(F.unhex(F.md5(F.col("value").cast("binary"))).alias("id"), "value")


# --- edit distance ------------------------------------------------------------------------------


def _forms(limit: int) -> str:
    """Keys of a short text: itself with up to ``limit`` characters left out. Texts within the limit share one."""
    forms, level = ["array(text)"], "array(text)"
    for _ in range(limit):
        level = (f"array_distinct(flatten(transform({level}, s -> IF(length(s) = 0, CAST(array() AS array<string>), "
                 "transform(sequence(1, length(s)), j -> concat(left(s, j - 1), substring(s, j + 1)))))))")
        forms.append(level)
    return (f"transform(array_distinct(concat({', '.join(forms)})), "
            "s -> named_struct('key', xxhash64('form', s), 'at', -1, 'size', 0))")


_NO_KEYS = "CAST(array() AS array<struct<key:bigint,at:int,size:int>>)"


def _segment(length: str, limit: int, then: str) -> str:
    """``then`` for each of the ``limit + 1`` segments (number, start, width) of a text of some length."""
    parts = limit + 1
    fields = ("named_struct('i', i, 'width', {n} div {m} + IF(i >= {m} - {n} % {m}, 1, 0), "
              "'start', i * ({n} div {m}) + greatest(0, i - ({m} - {n} % {m})))").format(n=length, m=parts)
    return f"transform(transform(sequence(0, {limit}), i -> {fields}), g -> {then})"


def index_keys(limit: int) -> str:
    """Keys of ``text`` on the indexed side: its ``limit + 1`` segments, whatever its length; forms if it is too short for them."""
    one = ("named_struct('key', xxhash64(length(text), g.i, substring(text, CAST(g.start + 1 AS INT), CAST(g.width AS INT))), "
           "'at', CAST(g.start AS INT), 'size', CAST(g.width AS INT))")
    return f"IF(length(text) > {limit}, {_segment('length(text)', limit, one)}, {_forms(limit)})"


def probe_keys(limit: int) -> str:
    """Keys of ``text`` on the asking side: for each length within the limit, the substrings that a segment there could equal.

    If ``limit`` edits turn one text into the other, one of the ``limit + 1`` segments is untouched; counted from the left
    and from the right, the edits before and after it bound how far it has moved, so few places are left.
    """
    low = f"greatest(0L, CAST(g.start - g.i AS BIGINT), CAST(g.start - d - ({limit} - g.i) AS BIGINT))"
    high = f"least(CAST(length(text) - g.width AS BIGINT), CAST(g.start + g.i AS BIGINT), CAST(g.start - d + ({limit} - g.i) AS BIGINT))"
    one = ("named_struct('key', xxhash64(CAST(length(text) + d AS INT), g.i, substring(text, CAST(p + 1 AS INT), CAST(g.width AS INT))), "
           "'at', CAST(p AS INT), 'size', CAST(g.width AS INT))")
    places = f"IF({low} > {high}, {_NO_KEYS}, transform(sequence({low}, {high}), p -> {one}))"
    windows = (f"flatten(transform(sequence(-{limit}, {limit}), d -> IF(length(text) + d <= {limit}, {_NO_KEYS}, "
               f"flatten({_segment('(length(text) + d)', limit, places)}))))")
    return f"IF(length(text) <= {2 * limit}, concat({windows}, {_forms(limit)}), {windows})"


def _keyed(texts: DataFrame, keys: str) -> DataFrame:
    """A row per key of ``(id, above, text)``, with what is left of the text beside the segment."""
    rows = texts.select("id", "above", "text", F.explode_outer(F.expr(keys)).alias("k")).filter(F.col("k").isNotNull())
    return rows.selectExpr("id", "xxhash64(above, k.key) AS key", "k.at >= 0 AS divisible",
                           "concat(left(text, k.at), substring(text, k.at + k.size + 1)) AS text")


def _candidates(index: DataFrame, probe: DataFrame, limit: int, crowd: int, rounds: int, check: bool = False) -> DataFrame:
    """``(left_id, right_id)`` that share a key; with ``check`` only if what is left beside the segment is within the limit too,
    as it is for some key of every close pair. That is seen where the two meet, so pairs that are not close go no further.

    A segment that very many values share says little: for those, what is left beside it has to be as close
    as the whole was, so it is cut in the same way again and the new key joins the old one. Without
    such segments adaptive execution drops that branch.
    """
    i, p = _keyed(index, index_keys(limit)), _keyed(probe, probe_keys(limit))

    def met(a: DataFrame, b: DataFrame) -> DataFrame:
        text = [F.when(F.length("text") <= CARRIED, F.col("text")).alias("text")] if check else []
        a, b = (side.select("key", "id", *text) for side in (a, b))
        pairs = a.withColumnsRenamed({"id": "right_id", "text": "right_text"}).join(
            b.withColumnsRenamed({"id": "left_id", "text": "left_text"}).hint("merge"), "key")
        if check:
            pairs = pairs.filter(F.coalesce(F.levenshtein("left_text", "right_text", limit) >= 0, F.lit(True)))
        return pairs.select("left_id", "right_id")

    if rounds <= 1:
        return met(i, p)
    crowded = i.filter("divisible").groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd).select("key")
    deeper = [side.join(crowded, "key", "left_semi").select("id", F.col("key").alias("above"), "text") for side in (i, p)]
    return met(i.join(crowded, "key", "left_anti"), p).unionByName(_candidates(*deeper, limit, crowd, rounds - 1, check))


def close_pairs(left: DataFrame, right: DataFrame, left_col: str, right_col: str, limit: int,
                crowd: int = CROWD, rounds: int = ROUNDS) -> DataFrame:
    """``(left_value, right_value, distance)`` of all distinct values within an edit distance.

    Exact. A right value has ``limit + 1`` keys however long it is, a left value a number that depends on ``limit`` alone; texts
    of up to ``limit`` characters (on the left twice that) also have their shortened forms. Keys that more than ``crowd``
    right values share are made finer, up to ``rounds`` times in all. Null values match nothing.
    """
    if limit < 0:
        raise ValueError("an edit distance is not below zero")
    a, b = values_of(left, left_col), values_of(right, right_col)
    index, probe = (side.select("id", F.lit(0).cast("long").alias("above"), F.col("value").alias("text")) for side in (b, a))
    found = _candidates(index, probe, limit, crowd, rounds, check=True).distinct()
    # Both sides grow with the input, and a side that is just small enough to be sent to all tasks is built up by the driver,
    # several at a time; so all of them are merged.
    named = (found.join(a.select(F.col("id").alias("left_id"), F.col("value").alias("left_value")).hint("merge"), "left_id")
             .join(b.select(F.col("id").alias("right_id"), F.col("value").alias("right_value")).hint("merge"), "right_id"))
    within = F.levenshtein("left_value", "right_value", limit)
    return named.select("left_value", "right_value", within.alias("distance")).filter(F.col("distance") >= 0)


# --- token overlap ------------------------------------------------------------------------------


def bands_for(threshold: float, recall: float, hashes: int = HASHES) -> tuple[int, int]:
    """Bands and rows a band: the longest rows, so the fewest chance candidates, that still find a pair at the threshold
    with the wanted chance. Pairs above it are found more surely."""
    fits = [r for r in range(1, hashes + 1) if 1 - (1 - threshold ** r) ** (hashes // r) >= recall]
    if not fits:
        raise ValueError(f"{hashes} hashes cannot reach a recall of {recall} at {threshold}")
    return hashes // max(fits), max(fits)


def band_keys(words: Column, bands: int, rows: int) -> Column:
    """A key a band: the hash of the least hashes of the words under ``rows`` seeds."""
    def least(b: Column) -> Column:
        # Of this band only: an expression used in a lambda is worked out again for each of its elements.
        return F.transform(F.sequence(b * rows, b * rows + (rows - 1)), lambda seed: F.array_min(F.transform(words, lambda w: F.xxhash64(w, seed))))

    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.xxhash64(b, least(b)))


def similar_by_minhash(left: DataFrame, right: DataFrame, left_col: str, right_col: str, threshold: float, words: Column,
                       recall: float = 0.97, hashes: int = HASHES) -> DataFrame:
    """``(left_value, right_value, score)`` of distinct values whose token sets overlap by ``threshold`` or more.

    Every pair given is verified; a pair at the threshold is found with chance ``recall``. ``words`` is the token set of a column
    ``value``. Values with equal sets are a few rows until the end, so neither their keys nor their comparisons multiply. Values
    without tokens match nothing. Unlike the exact filter, tokens are neither counted nor shuffled one by one. Sets go along with
    their keys and are compared where they meet, in the first band that they share; those too large for that are compared later.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie in (0, 1]")
    bands, rows = bands_for(threshold, recall, hashes)

    def sets_of(df: DataFrame, col: str) -> DataFrame:
        made = values_of(df, col).select("value", F.array_sort(words).alias("words")).filter(F.size("words") > 0)
        return made.withColumn("set", F.unhex(F.md5(F.to_json("words").cast("binary"))))

    a, b = sets_of(left, left_col), sets_of(right, right_col)
    both = a.withColumn("right", F.lit(False)).unionByName(b.withColumn("right", F.lit(True)))
    share = F.pmod(F.xxhash64("value"), F.lit(SHARES)).alias("share")
    folded = (both.filter(F.size("words") <= CARRIED).groupBy("right", "set", share)
              .agg(F.first("words").alias("words"), F.collect_list("value").alias("values")))
    keyed = folded.select("right", "values", "words", band_keys(F.col("words"), bands, rows).alias("keys"))
    keyed = (keyed.select("right", "values", "words", "keys", F.posexplode_outer("keys").alias("at", "key")).filter(F.col("key").isNotNull())
             .select("key", "right", "values", "words", F.slice("keys", F.lit(1), F.col("at")).alias("before")))
    return overlapping(keyed, threshold).unionByName(_large_by_minhash(a, b, threshold, bands, rows))


def _large_by_minhash(a: DataFrame, b: DataFrame, threshold: float, bands: int, rows: int) -> DataFrame:
    """The pairs of which one set or both do not go along with their keys."""
    large = F.col("large")
    # The other set of a pair has at least the threshold's share of its words.
    sized = [s.filter(F.size("words") > threshold * CARRIED - 1e-9) for s in (a, b)]

    def keyed(sets: DataFrame, side: str) -> DataFrame:
        single = sets.groupBy("set").agg(F.first("words").alias("words"))
        keys = single.select(F.col("set").alias(f"{side}_set"), (F.size("words") > CARRIED).alias("large"),
                             band_keys(F.col("words"), bands, rows).alias("keys"))
        return keys.select(f"{side}_set", "large", F.explode_outer("keys").alias("key")).filter(F.col("key").isNotNull())

    i, j = keyed(sized[0], "left"), keyed(sized[1], "right")
    # Merged, since the driver would build up each side that is sent to all tasks.
    met = [i.filter(x).drop("large").join(j.filter(y).drop("large").hint("merge"), "key") for x, y in ((large, F.lit(True)), (~large, large))]
    found = met[0].unionByName(met[1]).select("left_set", "right_set").distinct()
    singles = [s.groupBy("set").agg(F.first("words").alias("words")) for s in sized]
    both = (found.join(singles[0].toDF("left_set", "left_words").hint("merge"), "left_set")
            .join(singles[1].toDF("right_set", "right_words").hint("merge"), "right_set"))
    shared = F.size(F.array_intersect("left_words", "right_words"))
    sizes = F.size("left_words") + F.size("right_words")
    scored = both.withColumn("shared", shared).filter(F.col("shared") >= F.lit(threshold / (1 + threshold)) * sizes - 1e-9).select(
        "left_set", "right_set", (F.col("shared") / (sizes - F.col("shared"))).alias("score"))
    return (scored.join(a.select(F.col("set").alias("left_set"), F.col("value").alias("left_value")).hint("merge"), "left_set")
            .join(b.select(F.col("set").alias("right_set"), F.col("value").alias("right_value")).hint("merge"), "right_set")
            .select("left_value", "right_value", "score"))
