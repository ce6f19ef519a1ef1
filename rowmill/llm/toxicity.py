"""Toxic passages: maximal scoring segments over word log-odds, calibrated by extreme values.

Words are counted once a document, in toxic, in clean and in all documents. A word's chance to be toxic
is a Dirichlet posterior: its prior is the posterior of all words with the same beginning, whose own
prior is the base rate; words that are frequent in the whole corpus need more labels to leave it. The
log-odds against the base rate, less a drift, score a word, so ordinary text runs downhill; a scoring word right after itself adds nothing and costs nothing. All maximal segments
of a text come from one linear scan (Ruzzo and Tompa). Segment scores of clean text follow an
extreme-value law; its two constants are computed from the clean training documents, and what the
segments of a text have above the level expected of its length is summed. One logistic curve over
that sum, fitted on the training rows, gives the score.

Words that can score are sent to the tasks when they are few enough; else the words of texts are joined with
them. Labels likewise: few enough are sent, else joined.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.llm.common import by_bytes, by_name, by_place, order_id, remembered, slices, stored, utf8

PRIOR, CORPUS_PRIOR, DRIFT = 5.0, 0.002, 1.5
PREFIX_CHARS = 4
SENT_WORDS, SENT_LABELS = 2_000_000, 4_000_000
BATCH_BYTES = 2 * 1024 * 1024
_MARKS = bytes.maketrans(bytes(c for c in range(128) if not chr(c).isalnum()), b" " * (128 - 62))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words; ASCII signs and white space part them."""
    return text.decode().lower().encode().translate(_MARKS).split()


def word_id(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


def prefix_id(word: bytes) -> int:
    """The class of words that share a beginning."""
    return xxhash.xxh64_intdigest(word.decode("utf-8", "replace")[:PREFIX_CHARS].encode(), 1) - (1 << 63)


def held_out(doc_id: Column, parts: int = 3, part: int = 1) -> Column:
    """Rows whose labels are never learned from; a null id is one of the others."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def _one_label(labels: DataFrame, parts: int, part: int) -> DataFrame:
    """A training label per id; of several the larger holds. Null ids and labels teach nothing."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"), parts, part))
    return known.groupBy(order_id().alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("label"))


def with_label(docs: DataFrame, labels: DataFrame, sent: int = SENT_LABELS) -> DataFrame:
    """doc_id, text, hash (of the text) and ``label`` (null, 0 or 1). A set of up to ``sent`` labels goes to the tasks."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("hash"))
    labels = stored(labels, "labels")
    if labels.count() > sent:
        return plain.join(labels, "doc_id", "left")
    rows = labels.toPandas().sort_values("doc_id")
    shared = docs.sparkSession.sparkContext.broadcast((rows["doc_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, marks = shared.value
        for batch in batches:
            own = batch.column("doc_id")
            wanted = own.fill_null(0).to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(ids, wanted), max(0, len(ids) - 1))
            none = np.ones(len(wanted), bool) if not len(ids) else (ids[at] != wanted) | own.is_null().to_numpy(zero_copy_only=False)
            label = pa.array(marks[at] if len(ids) else np.zeros(len(wanted), np.int32), pa.int32(), mask=none)
            yield pa.RecordBatch.from_arrays([own, batch.column("text"), batch.column("hash"), label], names=["doc_id", "text", "hash", "label"])

    return plain.mapInArrow(run, "doc_id long, text string, hash long, label int")


class Ids(dict):
    """Word to (word id, prefix id), remembered by a worker up to a number of words."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) > 120_000:
            self.clear()
        self[word] = value = (word_id(word), prefix_id(word))
        return value


def word_counts(labelled: DataFrame) -> DataFrame:
    """(word, prefix, toxic, clean, n): documents that hold a word, by label, over all of ``labelled``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = remembered("word ids", Ids)
        for batch in batches:
            labels, texts = batch.column("label").to_pylist(), utf8(batch.column("text"))
            for start, end in by_bytes(texts, 4 * BATCH_BYTES):
                ids, sizes = [], []
                for text in texts[start:end]:
                    own = set(words_of(text))
                    ids.extend(map(known.__getitem__, own))
                    sizes.append(len(own))
                pairs = np.array(ids, np.int64).reshape(-1, 2)
                mark = np.repeat(np.array([-1 if x is None else x for x in labels[start:end]], np.int64), sizes)
                order = np.argsort(pairs[:, 0], kind="stable")
                pairs, mark = pairs[order], mark[order]
                first = np.flatnonzero(np.concatenate([[True], pairs[1:, 0] != pairs[:-1, 0]])) if len(pairs) else np.zeros(0, np.int64)
                sums = [np.add.reduceat(x.astype(np.int64), first) if len(first) else first for x in (mark == 1, mark == 0, mark > -2)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (pairs[first, 0], pairs[first, 1], *sums)],
                                                 names=["word", "prefix", "toxic", "clean", "n"])

    rows = labelled.select("text", "label").mapInArrow(run, "word long, prefix long, toxic long, clean long, n long")
    return rows.groupBy("word", "prefix").agg(*(F.sum(c).alias(c) for c in ("toxic", "clean", "n")))


class Model:
    """Words and prefixes that score, and the constants that turn segments into a probability."""

    def __init__(self, spark, labelled: DataFrame, sent_words: int = SENT_WORDS):
        counts = stored(word_counts(labelled), "word-counts")
        sums = counts.agg(F.sum("toxic"), F.sum("clean")).first()
        self.toxic, self.clean = sums[0] or 0, sums[1] or 0
        self.base = min(max((self.toxic + 0.5) / (self.toxic + self.clean + 1), 1e-6), 1 - 1e-6)
        logit = float(np.log(self.base / (1 - self.base)))
        seen = counts.groupBy("prefix").agg(*(F.sum(c).alias(c) for c in ("toxic", "clean", "n")))
        mass = PRIOR + CORPUS_PRIOR * F.col("n")
        rate = (F.col("toxic") + mass * self.base) / (F.col("toxic") + F.col("clean") + mass)
        prefixes = stored(seen.select("prefix", rate.alias("rate")), "prefixes")
        mean = F.coalesce("rate", F.lit(self.base))
        own = (F.col("toxic") + mass * mean) / (F.col("toxic") + F.col("clean") + mass)
        odds = lambda p: F.log(p / (1 - p)) - logit - DRIFT
        words = counts.join(prefixes, "prefix", "left").select(
            F.col("word").alias("id"), odds(own).alias("score"), odds(mean).alias("by_prefix"), (F.col("clean") + 0.1).alias("clean"))
        scoring = words.filter((F.col("score") > 0) | (F.col("by_prefix") > 0)).select("id", F.lit(False).alias("prefix"), "score", "clean")
        begun = prefixes.select(F.col("prefix").alias("id"), F.lit(True).alias("prefix"), odds(F.col("rate")).alias("score"), F.lit(0.0).alias("clean"))
        self.words = stored(scoring.unionByName(begun.filter("score > 0")), "scores")
        self.rate = self._rate()
        self.shared = None
        if self.words.count() <= sent_words:
            rows = self.words.toPandas()
            # Ids of words and of prefixes come from different seeds, so one sorted table holds both.
            order = np.argsort(rows["id"].to_numpy(np.int64), kind="stable")
            self.shared = spark.sparkContext.broadcast((rows["id"].to_numpy(np.int64)[order], rows["score"].to_numpy(np.float64)[order]))
        self.level, self.slope, self.offset = 0.0, 0.0, logit

    def _rate(self) -> float:
        """The positive root of sum p(s) exp(rate s) = 1 over the scores of clean text."""
        up = [(r["score"], r["clean"]) for r in self.words.filter("score > 0 and not prefix").groupBy(
            F.round("score", 2).alias("score")).agg(F.sum("clean").alias("clean")).collect()]
        score, weight = np.array([u[0] for u in up]), np.array([u[1] for u in up])
        total = self.clean + 1.0 + weight.sum()
        low, high = 0.01, 5.0
        for _ in range(60):
            mid = (low + high) / 2
            value = (weight / total * np.exp(mid * score)).sum() + (1 - weight.sum() / total) * np.exp(-mid * DRIFT)
            low, high = (mid, high) if value < 1 else (low, mid)
        return low


def maximal_segments(places: list[int], scores: list[float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score); words between ``places`` cost the drift each.

    One pass: each scoring word starts a segment, which joins those to its left that it can extend. A place
    with score 0 costs no drift and makes no segment of its own.
    """
    done: list[list] = []  # start, end, sum before, sum after
    total, before = 0.0, -1
    for place, score in zip(places, scores):
        total -= drift * (place - before - 1)
        part = [place, place + 1, total, total + score]
        total, before = part[3], place
        while True:
            j = len(done) - 1
            while j >= 0 and done[j][2] >= part[2]:
                j -= 1
            if j < 0 or done[j][3] >= part[3]:
                done.append(part)
                break
            part = [done[j][0], part[1], done[j][2], part[3]]
            del done[j:]
    return [(s, e, after - start) for s, e, start, after in done if after > start]


def segments(labelled: DataFrame, model: Model) -> DataFrame:
    """doc_id, label, n_words and the maximal segments of each row's text."""
    schema = "doc_id long, hash long, label int, n_words long, segments array<struct<start:int,end:int,score:double>>"
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def shown(parts) -> list[dict]:
        return [{"start": s, "end": e, "score": v} for s, e, v in parts]

    if model.shared is None:
        return _joined_segments(labelled, model, schema, kind, shown)
    shared, name = model.shared, uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, scores = shared.value
        known = remembered(name, dict)

        def learn(words: list[bytes]) -> None:
            both = np.array([(word_id(w), prefix_id(w)) for w in words], np.int64).reshape(-1, 2)
            at = np.minimum(np.searchsorted(ids, both), max(0, len(ids) - 1))
            hit = ids[at] == both if len(ids) else np.zeros(both.shape, bool)
            value = np.where(hit[:, 0], scores[at[:, 0]], np.where(hit[:, 1], scores[at[:, 1]], 0.0)) if len(ids) else np.zeros(len(words))
            known.update(zip(words, np.maximum(value, 0.0).tolist()))

        for batch in slices(batches, keep=True):
            texts, lengths, found = utf8(batch.column("text")), [], []
            for start, end in by_bytes(texts, BATCH_BYTES):
                lists = [words_of(t) for t in texts[start:end]]
                new = set().union(*lists) - known.keys()
                if len(known) + len(new) > 200_000:
                    known.clear()
                    new = set().union(*lists)
                learn(list(new))
                for words in lists:
                    value = np.fromiter(map(known.__getitem__, words), np.float64, len(words))
                    places = np.flatnonzero(value).tolist()
                    up = [0.0 if p and words[p] == words[p - 1] else float(value[p]) for p in places]
                    lengths.append(len(words))
                    found.append(shown(maximal_segments(places, up)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "hash", "label")), pa.array(lengths, pa.int64()), pa.array(found, kind)],
                                             names=["doc_id", "hash", "label", "n_words", "segments"])

    return labelled.mapInArrow(run, schema)


def _joined_segments(labelled: DataFrame, model: Model, schema: str, kind: pa.DataType, shown) -> DataFrame:
    """The same segments where the scoring words are too many to send: words of texts meet them in a join."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = remembered("word ids", Ids)
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), utf8(batch.column("text"))):
                own = words_of(text)
                first = [i for i, w in enumerate(own) if not i or w != own[i - 1]]
                for at in range(0, len(first), 100_000):
                    part = first[at:at + 100_000]
                    pairs = np.array([known[own[i]] for i in part], np.int64).reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays([pa.array([row] * len(part), pa.int64()), pa.array(part, pa.int64()),
                                                      pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["row", "place", "word", "prefix"])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, lengths = [], []
            for hits, text in zip(batch.column("hits").to_pylist(), utf8(batch.column("text"))):
                own, places, up = words_of(text), [], []
                for hit in sorted(hits or [], key=lambda h: h["place"]):
                    places.append(hit["place"])
                    up.append(hit["score"])
                    while places[-1] + 1 < len(own) and own[places[-1] + 1] == own[places[-1]]:
                        places.append(places[-1] + 1)
                        up.append(0.0)
                lengths.append(len(own))
                found.append(shown(maximal_segments(places, up)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "hash", "label")), pa.array(lengths, pa.int64()), pa.array(found, kind)],
                                             names=["doc_id", "hash", "label", "n_words", "segments"])

    numbered = stored(labelled, "labelled").withColumn("row", F.monotonically_increasing_id())
    numbered = stored(numbered, "numbered")
    places = numbered.select("row", "text").mapInArrow(words, "row long, place long, word long, prefix long")
    own = model.words.filter("not prefix").select(F.col("id").alias("word"), F.col("score").alias("own"))
    begun = model.words.filter("prefix").select(F.col("id").alias("prefix"), F.col("score").alias("begun"))
    scored = places.join(begun, "prefix", "left").join(own, "word", "left").select("row", "place", F.coalesce("own", "begun").alias("score"))
    hits = scored.filter("score > 0").groupBy("row").agg(F.collect_list(F.struct("place", "score")).alias("hits"))
    return numbered.join(hits, "row", "left").select("doc_id", "hash", "label", "text", "hits").mapInArrow(close, schema)


def excess(rate: float, level: float) -> Column:
    """What the segments have above the level that clean text of this length reaches, in nats."""
    bar = F.log(F.greatest(F.col("n_words"), F.lit(1))) + level
    most = F.coalesce(F.array_max(F.transform("segments", lambda s: s["score"])), F.lit(0.0)) * rate - bar
    total = F.aggregate(F.filter(F.transform("segments", lambda s: s["score"] * rate - bar), lambda v: v > 0), F.lit(0.0), lambda a, b: a + b)
    return F.when(total > 0, total).otherwise(most)


def score(docs: DataFrame, labels: DataFrame, parts: int = 3, part: int = 1, sent_words: int = SENT_WORDS,
          sent_labels: int = SENT_LABELS) -> DataFrame:
    """doc_id, hash (of the text), held_out, score (0 to 1), n_words and the significant passages (word places and scores).

    Learns from labels of rows that are not held out and from the words of all documents; ids, languages
    and sources play no part. A null or empty text has no words and gets what a text without segments
    gets. Segments of any score above zero are tested against the bar of their text's length; no floor
    stands before it. Of repeated labels the larger holds; repeated documents count and are scored one by one; a null
    id has no label. Without labels of both kinds every score is the base rate (a half where there are
    no labels). An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    labelled = with_label(by_place(docs, ("doc_id", "text"))[0], _one_label(labels, parts, part), sent_labels)
    model = Model(spark, labelled, sent_words)
    found = stored(segments(labelled, model), "segments")
    most = F.coalesce(F.array_max(F.transform("segments", lambda s: s["score"])), F.lit(0.0))
    tail = found.filter("label = 0").agg(F.count("*"), F.sum(F.greatest(F.col("n_words"), F.lit(1)) * F.exp(-model.rate * most))).first()
    model.level = float(np.log(tail[0] / tail[1])) if tail[0] and tail[1] else 0.0
    above = excess(model.rate, model.level)
    bins = found.filter("label is not null").groupBy(F.round(F.least(F.greatest(above, F.lit(-30.0)), F.lit(300.0)), 1).alias("x"), "label").count().collect()
    model.slope, model.offset = logistic(np.array([r["x"] for r in bins]), np.array([r["label"] for r in bins]), np.array([r["count"] for r in bins], float))
    chance = 1 / (1 + F.exp(-(above * model.slope + model.offset)))
    bar = F.log(F.greatest(F.col("n_words"), F.lit(1))) + model.level
    return found.select("doc_id", "hash", held_out(F.col("doc_id"), parts, part).alias("held_out"), chance.alias("score"), "n_words",
                        F.filter("segments", lambda s: s["score"] * model.rate > bar).alias("passages"))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope (not below zero) and offset of a weighted logistic curve, by Newton's method."""
    if len(np.unique(y)) < 2:
        rate = (weight[y == 1].sum() + 0.5) / (weight.sum() + 1) if len(y) else 0.5
        return 0.0, float(np.log(rate / (1 - rate)))
    a, b = 0.5, float(np.log(weight[y == 1].sum() / weight[y == 0].sum()))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -35, 35)))
        g = np.array([(weight * (p - y) * x).sum() + ridge * a, (weight * (p - y)).sum()])
        w = weight * np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * x * x).sum() + ridge, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return max(float(a), 0.0), float(b)


def keep_clean(docs: DataFrame, labels: DataFrame, limit: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``limit``; columns as they are."""
    plain, names = by_place(docs, ("doc_id", "text"))
    scored = score(plain, labels).filter(F.col("score") >= limit).select(order_id().alias("__id"), F.col("hash").alias("__hash")).distinct()
    tagged = plain.withColumns({"__id": order_id(), "__hash": F.xxhash64("text")})
    return by_name(tagged.join(scored, ["__id", "__hash"], "left_anti").select(*plain.columns), names)
