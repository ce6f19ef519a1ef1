"""Benchmark decontamination: BM25 over test items, searched by every passage with block-max WAND.

The items are the indexed side, so the index is small and the corpus is scanned once, without a
shuffle. An item's impacts are scaled by its score for itself: a passage that holds all of an item
scores one. Passages are windows of twice the longest item, half of it shared with the next, so an item
that occurs lies in one of them. Retrieved are all items at or above the threshold; verified are those of whose
question and answer, each, most word shingles occur in the passage. With ``whole``, items of whose shingles as a whole most
occur are verified too: a part of few words, where one changed word spoils most, is so judged together with its neighbour.

Before a passage is searched, a bound is tried on all passages of a batch at once: an item can only
reach the threshold if its own rare terms, without its common ones' total, bring enough within a
passage's length. That is the bound by which WAND passes over lists, taken per item; it loses nothing.

An index is built of items up to a number of bytes, and larger sets are searched block by block with
the same corpus-wide term statistics.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.llm.common import by_bytes, by_name, by_place, remembered, slices

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.8
SHINGLE = 5
RARE_SHARE = 0.8
POSTING_BLOCK = 64
INDEX_BYTES = 32 * 1024 * 1024
BATCH_BYTES = 1 << 20
_MARKS = bytes.maketrans(bytes(c for c in range(128) if not chr(c).isalnum()), b" " * (128 - 62))
_SENTENCE = re.compile(r"(?s)^(.*\S.*?[.?!:\n])\s*(\S.*)$")


def terms_of(text: str | None) -> list[bytes]:
    """Lower-cased words; ASCII signs and white space part them."""
    return (text or "").lower().encode().translate(_MARKS).split()


def question_and_answer(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """The last sentence or line is the answer; of a single one, the second half is."""
    body = (text or "").strip()
    found = _SENTENCE.match(body)
    if found:
        parts = terms_of(found[1]), terms_of(found[2])
        if all(parts):
            return parts
    words = terms_of(body)
    return words[: len(words) // 2], words[len(words) // 2:]


def shingles(words: list[bytes], n: int = SHINGLE) -> set[tuple[bytes, ...]]:
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def contained(part: list[bytes], passage: set, words: list[bytes], n: int = SHINGLE) -> float:
    """Share of a part's shingles in the passage; a part shorter than a shingle must occur as it is."""
    if not part:
        return 1.0
    if len(part) < n:
        k = len(part)
        return float(any(words[i:i + k] == part for i in range(len(words) - k + 1)))
    own = shingles(part, n)
    return len(own & passage) / len(own)


class Index:
    """Postings with block maxima over scaled impacts, and per-item rare terms."""

    def __init__(self, items: list[tuple], frequency: dict[bytes, int], n_items: int, mean_length: float,
                 threshold: float = THRESHOLD, whole: bool = False):
        self.threshold, self.whole, self.ids, self.parts = threshold, whole, [], []
        self.vocab: dict[bytes, int] = {}
        postings: list[list[tuple[int, float]]] = []
        rare: list[list[tuple[int, float]]] = []
        self.need, longest = [], 1
        for item, text in items:
            parts = question_and_answer(text)
            words = parts[0] + parts[1]
            if not words:
                continue
            at, longest = len(self.ids), max(longest, len(words))
            self.ids.append(item)
            self.parts.append(parts)
            norm = K1 * (1 - B + B * len(words) / mean_length)
            impacts = {}
            for term, tf in Counter(words).items():
                df = frequency[term]
                impacts[term] = math.log(1 + (n_items - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + norm)
            total, taken = sum(impacts.values()), 0.0
            for term in sorted(impacts, key=lambda t: (frequency[t], t)):
                number = self.vocab.setdefault(term, len(self.vocab))
                if number == len(postings):
                    postings.append([])
                    rare.append([])
                weight = impacts[term] / total
                postings[number].append((at, weight))
                if taken < RARE_SHARE:
                    rare[number].append((at, weight))
                    taken += weight
            self.need.append(threshold - (1 - taken) - 1e-9)
        self.window, self.stride = 2 * longest, longest
        self.lists = [([p[0] for p in plist], [p[1] for p in plist], max(p[1] for p in plist),
                       [max(p[1] for p in plist[i:i + POSTING_BLOCK]) for i in range(0, len(plist), POSTING_BLOCK)])
                      for plist in postings]
        sizes = [len(r) for r in rare]
        self.rare_from = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.rare_item = np.array([p[0] for r in rare for p in r], np.int64)
        self.rare_weight = np.array([p[1] for r in rare for p in r])
        self.need = np.array(self.need)

    def search(self, terms: set[int]) -> list[tuple[int, float]]:
        """All items whose impacts for ``terms`` sum to the threshold at least (block-max WAND)."""
        limit, found = self.threshold - 1e-9, []
        cursors = [[self.lists[t][0][0], 0, self.lists[t]] for t in terms]  # item, place, list
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, None
            for n, cursor in enumerate(cursors):
                bound += cursor[2][2]
                if bound >= limit:
                    pivot = n
                    break
            if pivot is None:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            if cursors[0][0] < item:
                goal, moved = item, cursors[:pivot + 1]
            else:
                moved = cursors[:pivot + 1]
                if sum(c[2][3][c[1] // POSTING_BLOCK] for c in moved) >= limit:
                    score = sum(c[2][1][c[1]] for c in moved)
                    if score >= limit:
                        found.append((item, score))
                    goal = item + 1
                else:  # no item up to the nearest block end, or up to the next list, can do it
                    ends = [c[2][0][min((c[1] // POSTING_BLOCK + 1) * POSTING_BLOCK, len(c[2][0])) - 1] + 1 for c in moved]
                    later = [cursors[pivot + 1][0]] if pivot + 1 < len(cursors) else []
                    goal = max(item + 1, min(ends + later))
            for cursor in moved:
                items, place = cursor[2][0], cursor[1]
                while place < len(items) and items[place] < goal:
                    place += 1
                cursor[1], cursor[0] = place, items[place] if place < len(items) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def promising(self, numbers: np.ndarray) -> np.ndarray:
        """Places where, within a window's length, some item's rare terms bring what it needs."""
        at = np.flatnonzero(numbers >= 0)
        terms = numbers[at]
        count = self.rare_from[terms + 1] - self.rare_from[terms]
        at, first = np.repeat(at, count), np.repeat(self.rare_from[terms], count)
        entry = first + np.arange(len(first)) - np.repeat(np.cumsum(count) - count, count)
        item, weight = self.rare_item[entry], self.rare_weight[entry]
        span = len(numbers) + self.window + 1
        key = item * span + at
        order = np.argsort(key, kind="stable")
        key, total = key[order], np.concatenate([[0.0], np.cumsum(weight[order])])
        end = np.searchsorted(key, key + self.window)
        gained = total[end] - total[np.arange(len(key))]
        return np.unique(at[order][gained >= self.need[item[order]]])

    def leaks(self, words: list[bytes], numbers: np.ndarray, near: np.ndarray) -> Iterator[tuple]:
        """(item, score, question share, answer share) of the verified items, best passage of each."""
        first = np.maximum(near - self.window, -1) // self.stride + 1
        passages = sorted({int(p) for a, b in zip(first, near // self.stride) for p in range(a, b + 1)})
        best: dict[int, tuple] = {}
        for p in passages:
            lo, hi = p * self.stride, p * self.stride + self.window
            if lo >= len(words):
                continue
            hits = self.search({int(n) for n in np.unique(numbers[lo:hi]) if n >= 0})
            if not hits:
                continue
            part = words[lo:hi]
            held = shingles(part)
            for item, score in hits:
                question, answer = (contained(x, held, part) for x in self.parts[item])
                if min(question, answer) >= OVERLAP or self.whole and contained(sum(self.parts[item], []), held, part) >= OVERLAP:
                    best[item] = max(best.get(item, ()), (score, question, answer))
        for item, row in best.items():
            yield self.ids[item], *row


def _index(shared) -> Index:
    """One index per worker, built from the block that was sent."""
    return remembered(shared.value["name"], lambda: Index(*shared.value["args"]))


def blocks(items: DataFrame, index_bytes: int = INDEX_BYTES, threshold: float = THRESHOLD, whole: bool = False) -> Iterator:
    """Broadcast blocks of items of bounded size, each with its terms' counts over all items."""
    import uuid

    spark = items.sparkSession
    items = items.select("item_id", F.col("text").cast("string").alias("text")).filter(F.length("text") > 0)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(t, n) for text in batch.column("text").to_pylist() for w in [terms_of(text)]
                    for t, n in [(x, 0) for x in set(w)] + [(b"", len(w))] if w]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64())], names=["term", "n"])

    counted = items.mapInArrow(words, "term binary, n long").groupBy("term").agg(F.count("*").alias("df"), F.sum("n").alias("n"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // index_bytes))
    total = [r for r in counted.filter(F.col("term") == F.lit(b"")).collect()]
    if not total:
        return
    n_items, mean_length = total[0]["df"], total[0]["n"] / total[0]["df"]
    for part in range(parts):
        block = items.filter(F.pmod(F.xxhash64("text"), F.lit(parts)) == part)
        own = block.mapInArrow(words, "term binary, n long").select("term").distinct()
        frequency = {bytes(r["term"]): r["df"] for r in counted.join(own, "term", "left_semi").collect()}
        rows = sorted(((r["item_id"], r["text"]) for r in block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield spark.sparkContext.broadcast({"name": uuid.uuid4().hex, "args": (rows, frequency, n_items, mean_length, threshold, whole)})


def found_in(shared, texts: list[str | None]) -> Iterator[tuple[int, list[tuple]]]:
    """Row number and leaks of each text that has any."""
    index = _index(shared)
    get, gap = index.vocab.get, np.full(index.window, -1, np.int64)
    raw = [t or "" for t in texts]
    for start, end in by_bytes(raw, BATCH_BYTES):
        words = [terms_of(t) for t in raw[start:end]]
        numbers = [np.fromiter(map(get, w, repeat(-1)), np.int64, len(w)) for w in words]
        offsets = np.cumsum([0, *(len(n) + len(gap) for n in numbers)])
        near = index.promising(np.concatenate([x for n in numbers for x in (n, gap)]))
        if not len(near):
            continue
        owner = np.searchsorted(offsets, near, side="right") - 1
        for i in np.unique(owner).tolist():
            rows = list(index.leaks(words[i], numbers[i], near[owner == i] - offsets[i]))
            if rows:
                yield start + i, rows


def contamination(docs: DataFrame, items: DataFrame, index_bytes: int = INDEX_BYTES, whole: bool = False) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): items found in each row of ``docs``.

    Both overlaps reach 0.8; a part of under five words has 1 where it stands verbatim, else 0. With ``whole`` it is also
    enough that the item's shingles as a whole reach 0.8; one overlap may then be lower, down to 0.
    Null and empty texts hold nothing, null and empty items are found nowhere; items with null ids are found under a null
    id. Repeated items count in the term statistics and are reported as often as their rows, repeated
    documents likewise. An empty table on either side gives no rows. Other columns are not read.
    """
    docs = by_place(docs, ("doc_id", "text"))[0]
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    out = docs.sparkSession.createDataFrame([], schema)
    for shared in blocks(items, index_bytes, whole=whole):
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, keep=True):
                ids = batch.column("doc_id").to_pylist()
                rows = [(ids[i], *r) for i, leaks in found_in(shared, batch.column("text").to_pylist()) for r in leaks]
                if rows:
                    ints, floats = pa.int64(), pa.float64()
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (ints, ints, floats, floats, floats))],
                                                     names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
        out = out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, index_bytes: int = INDEX_BYTES, whole: bool = False) -> DataFrame:
    """The rows of ``docs`` that hold no item, columns as they are; ``whole`` as in ``contamination``."""
    plain, names = by_place(docs, ("text",))
    for shared in blocks(items, index_bytes, whole=whole):
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, keep=True):
                hit = {i for i, _ in found_in(shared, batch.column("text").to_pylist())}
                yield batch.filter(pa.array([i not in hit for i in range(batch.num_rows)], pa.bool_()))

        plain = plain.mapInArrow(run, plain.schema)
    return by_name(plain, names)
