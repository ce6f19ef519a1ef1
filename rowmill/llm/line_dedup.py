"""Reversible line de-duplication: exact reference counts, with sharded cuckoo filters in front.

The exact side is a table of references: a row for each line key and document that holds it, once.
Inserting a document adds its references and deleting it removes them, so any state can be undone.
Counts (documents of a key, the largest of them) come from the references by plain aggregation.

Keys held by enough documents go into cuckoo filters, one per shard of the key space. Buckets have
four slots of 16-bit marks and a key has two buckets, so a mark can be taken out again when a deletion
makes its key rare. To clean a text, its lines ask the filters first; only what they let through goes
on to the exact counts by a join, so false marks change nothing. The filters travel to all tasks where
their total size, known beforehand from the number of keys, is within a limit; else all lines go to
the exact join. Equal keys of one task are counted there before any shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.llm.common import by_name, by_place, order_id, slices, stored, utf8

MIN_CHARS, MIN_DOCS = 40, 5
SPACES = b" \t\n\x0b\f\r"
SLOTS, MARK_BYTES, LOAD, KICKS = 4, 2, 0.8, 500
SHARD_KEYS = 1 << 18
MOST_CHANGES = 16
FILTER_BYTES = 64 * 1024 * 1024
_LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """128 bits of a stripped, lower-cased line; None if it has too few code points."""
    line = line.strip(SPACES)
    if len(line) < min_chars or (len(line) < 4 * min_chars and len(line.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(line.translate(_LOW))


class CuckooFilter:
    """Marks of 64-bit hashes in two possible buckets each; insert, delete and look up many at once."""

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.buckets = buckets  # a power of two
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        return cls(1 << max(2, int(np.ceil(np.log2(max(1, n) / SLOTS / LOAD)))))

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        table = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        return cls(len(table), table)

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        marks = (hashes >> np.uint64(48)).astype(np.uint16)
        marks[marks == 0] = 1
        first = (hashes & np.uint64(self.buckets - 1)).astype(np.int64)
        return marks, first, self.other(first, marks)

    def other(self, bucket, mark):
        with np.errstate(over="ignore"):
            step = (np.asarray(mark, np.uint64) * _MIX) >> np.uint64(40)
        return np.asarray(bucket) ^ (step & np.uint64(self.buckets - 1)).astype(np.int64)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        marks, one, two = self.places(hashes)
        return ((self.table[one] == marks[:, None]) | (self.table[two] == marks[:, None])).any(axis=1)

    def insert(self, hashes: np.ndarray) -> bool:
        """False if it is too full; the caller then builds a larger one from the exact keys."""
        for mark, *both in zip(*self.places(hashes)):
            for bucket in both:
                free = np.flatnonzero(self.table[bucket] == 0)
                if len(free):
                    self.table[bucket, free[0]] = mark
                    break
            else:
                bucket = both[1]
                for turn in range(KICKS):
                    slot = turn % SLOTS
                    mark, self.table[bucket, slot] = self.table[bucket, slot], mark
                    bucket = int(self.other(bucket, mark))
                    free = np.flatnonzero(self.table[bucket] == 0)
                    if len(free):
                        self.table[bucket, free[0]] = mark
                        break
                else:
                    return False
        return True

    def delete(self, hashes: np.ndarray) -> None:
        """Take out one mark for each hash that was inserted."""
        for mark, *both in zip(*self.places(hashes)):
            for bucket in both:
                found = np.flatnonzero(self.table[bucket] == mark)
                if len(found):
                    self.table[bucket, found[0]] = 0
                    break


def build_filter(hashes: np.ndarray) -> CuckooFilter:
    made, n = CuckooFilter.for_keys(len(hashes)), len(hashes)
    while not made.insert(hashes):
        n = max(2 * n, 1)
        made = CuckooFilter.for_keys(n)
    return made


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(24)) % np.uint64(shards)).astype(np.int64)


def references(df: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(hi, lo, doc): each key of at least ``min_chars`` code points and a document that holds it, once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            docs, keys, owners = batch.column("doc").to_pylist(), [], []
            for doc, text in zip(docs, utf8(batch.column("text"))):
                found = {line_key(x, min_chars) for x in text.split(b"\n") if len(x) >= min_chars} - {None}
                keys.extend(found)
                owners.extend([doc] * len(found))
            if not keys:
                continue
            halves = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(owners, pa.int64())],
                                             names=["hi", "lo", "doc"])

    rows = by_place(df, ("doc_id", "text"))[0].select(order_id().alias("doc"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "hi long, lo long, doc long").distinct()


def counts(refs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(hi, lo, n_docs, last) of the keys that at least ``min_docs`` documents hold."""
    return refs.groupBy("hi", "lo").agg(F.count("*").alias("n_docs"), F.max("doc").alias("last")).filter(F.col("n_docs") >= min_docs)


class LineIndex:
    """References, exact counts and filters of a corpus, kept in the shared folder.

    ``insert`` and ``delete`` take documents and change all three; each writes what is new beside the
    old tables, so a failed call leaves the index as it was. ``clean`` drops repeated lines from texts.
    """

    def __init__(self, spark: SparkSession, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 shard_keys: int = SHARD_KEYS, filter_bytes: int = FILTER_BYTES):
        self.spark, self.min_chars, self.min_docs = spark, min_chars, min_docs
        self.shard_keys, self.filter_bytes = shard_keys, filter_bytes
        self.refs = self.common = self.filters = None
        self.shards = self.n_keys = self.changes = 0

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], "hi long, lo long, doc long")

    def insert(self, df: DataFrame) -> LineIndex:
        """Add documents; a doc_id that is there already gains the lines it did not have.

        Only the new references are written, beside the others, and only their keys are counted again.
        """
        new = stored(references(df, self.min_chars), "line-references")
        refs = new if self.refs is None else self.refs.unionByName(new)
        return self._move(refs, new.select("hi", "lo").distinct())

    def delete(self, ids: DataFrame) -> LineIndex:
        """Take out the documents with these ids, with all their references. Only the ids are written."""
        gone = stored(ids.select(order_id().alias("doc")).distinct(), "line-deletions")
        held = self._empty() if self.refs is None else self.refs
        touched = stored(held.join(gone, "doc", "left_semi").select("hi", "lo").distinct(), "line-touched")
        return self._move(held.join(gone, "doc", "left_anti"), touched)

    def _move(self, refs: DataFrame, touched: DataFrame) -> LineIndex:
        """Take ``refs``, of which the keys ``touched`` have changed. Many changes one above another are written as one."""
        self.changes += 1
        if self.changes % MOST_CHANGES == 0:
            refs = stored(refs.distinct(), "line-references")
        if self.common is None:
            counted = counts(refs, self.min_docs)
        else:
            again = counts(refs.join(touched, ["hi", "lo"], "left_semi").distinct(), self.min_docs)
            counted = self.common.join(touched, ["hi", "lo"], "left_anti").unionByName(again)
        common = stored(counted, "line-counts")
        n = common.count()
        rebuilt = self.filters is None or n > self.shards * self.shard_keys
        if rebuilt:
            shards = max(1, -(-2 * n // self.shard_keys))
            filters = self._built(common, shards)
        else:
            shards = self.shards
            filters = self._changed(common, shards)
        self.refs, self.common, self.filters, self.shards, self.n_keys = refs, common, stored(filters, "line-filters"), shards, n
        return self

    def _built(self, keys: DataFrame, shards: int) -> DataFrame:
        def build(rows: pd.DataFrame) -> pd.DataFrame:
            made = build_filter(rows["hi"].to_numpy().view(np.uint64))
            return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "marks": [made.to_bytes()]})

        part = F.pmod(F.shiftrightunsigned("hi", 24), F.lit(shards)).alias("shard")
        return keys.select("hi", part).groupBy("shard").applyInPandas(build, "shard long, marks binary")

    def _changed(self, common: DataFrame, shards: int) -> DataFrame:
        """Filters after the keys that became common went in and those that became rare came out."""
        old, new = self.common.select("hi", "lo"), common.select("hi", "lo")
        part = F.pmod(F.shiftrightunsigned("hi", 24), F.lit(shards)).alias("shard")
        change = (new.join(old, ["hi", "lo"], "left_anti").select("hi", part, F.lit(True).alias("comes")).unionByName(
            old.join(new, ["hi", "lo"], "left_anti").select("hi", part, F.lit(False).alias("comes"))))
        held = new.select("hi", part, F.lit(None).cast("boolean").alias("comes"))

        def turn(filters: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
            hashes = keys["hi"].to_numpy(np.int64).view(np.uint64)
            comes = keys["comes"].map({True: 1, False: 0}).fillna(-1).to_numpy()
            made = CuckooFilter.from_bytes(filters["marks"].iloc[0]) if len(filters) else CuckooFilter.for_keys(1)
            made.delete(hashes[comes == 0])
            if not made.insert(hashes[comes == 1]):
                made = build_filter(hashes[comes == -1])
            shard = filters["shard"].iloc[0] if len(filters) else keys["shard"].iloc[0]
            return pd.DataFrame({"shard": [shard], "marks": [made.to_bytes()]})

        return self.filters.groupBy("shard").cogroup(change.unionByName(held).groupBy("shard")).applyInPandas(turn, "shard long, marks binary")

    def asked(self, refs: DataFrame) -> DataFrame:
        """The references that the filters do not rule out."""
        # A table of n keys has n / LOAD slots at most, rounded up to a power of two, and grows once on bad luck.
        bound = int(4 * MARK_BYTES * self.n_keys / LOAD) + 64 * self.shards
        if bound > self.filter_bytes:
            return refs
        tables = {r["shard"]: r["marks"] for r in self.filters.collect()}
        shared, shards = self.spark.sparkContext.broadcast(tables), self.shards

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters = {s: CuckooFilter.from_bytes(m) for s, m in shared.value.items()}
            for batch in batches:
                hi, lo = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("hi", "lo"))
                hashes, open_ = hi.view(np.uint64), np.zeros(len(hi), bool)
                part = shard_of(hashes, shards)
                for s, marks in filters.items():
                    mine = np.flatnonzero(part == s)
                    open_[mine] = marks.holds(hashes[mine])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hi[open_]), pa.array(lo[open_]), batch.column("doc").filter(pa.array(open_))], names=["hi", "lo", "doc"])

        return refs.mapInArrow(run, "hi long, lo long, doc long")

    def drops(self, refs: DataFrame) -> DataFrame:
        """(doc, keys): the line keys that each document loses, as 16-byte values; none by an index without documents."""
        if self.common is None:
            self._move(self._empty(), self._empty().select("hi", "lo"))
        both = self.asked(refs).join(self.common, ["hi", "lo"]).filter(F.col("doc") < F.col("last"))
        key = F.concat(F.to_binary(F.lpad(F.hex("hi"), 16, "0"), F.lit("hex")), F.to_binary(F.lpad(F.hex("lo"), 16, "0"), F.lit("hex")))
        return both.groupBy("doc").agg(F.collect_list(key).alias("keys"))

    def clean(self, df: DataFrame, indexed: bool = False) -> DataFrame:
        """``df`` with repeated lines dropped from its texts, and n_lines, n_dropped of each.

        A line goes if its key is in at least ``min_docs`` documents of the index and another document
        with a larger doc_id holds it. A null or empty text has one empty line, which stays, and comes
        back as it was. A null doc_id is a document of its own before all others. Rows that share a
        doc_id are one document: none of them loses a line for the other. Columns named n_lines or
        n_dropped are replaced. ``indexed`` says that all of ``df`` is in the index, whose references
        then serve for its lines.
        """
        min_chars = self.min_chars
        plain, outer = by_place(df, ("doc_id", "text"), ("n_lines", "n_dropped"))
        drops = self.drops(self.refs if indexed and self.refs is not None else references(plain, min_chars))
        kept = plain.columns
        joined = plain.select(*kept, order_id().alias("__doc")).join(
            drops.select(F.col("doc").alias("__doc"), F.col("keys").alias("__keys")), "__doc", "left")
        schema = plain.schema.add("n_lines", "long").add("n_dropped", "long")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                texts, lines, dropped = [], [], []
                raw = batch.column("text").to_pylist()
                for text, keys in zip(raw, batch.column("__keys").to_pylist()):
                    lines.append((text or "").count("\n") + 1)
                    if not keys or not text:
                        texts.append(text)
                        dropped.append(0)
                        continue
                    gone = {k[7::-1] + k[:7:-1] for k in keys}
                    parts = text.encode().split(b"\n")
                    stay = [x for x in parts if len(x) < min_chars or line_key(x, min_chars) not in gone]
                    texts.append(b"\n".join(stay).decode())
                    dropped.append(len(parts) - len(stay))
                columns = {n: batch.column(n) for n in kept} | {"text": pa.array(texts, pa.string())}
                yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                                                 names=[*columns, "n_lines", "n_dropped"])

        return by_name(joined.select(*kept, "__keys").mapInArrow(run, schema), outer)


def dedup_lines(df: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """A corpus cleaned by the index of its own lines; see ``LineIndex.clean``."""
    return LineIndex(df.sparkSession, min_chars, min_docs).insert(df).clean(df, indexed=True)

