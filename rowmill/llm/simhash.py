"""SimHash near-duplicates: fingerprints within a few bits of each other, found by Golay-code keys.

A fingerprint of 64 bits has three segments of 22, 21 and 21 bits. Two errors leave one segment whole
whose next segment (cyclically) has at most one, so a pair shares a key of a whole segment and a codeword of the next. The
(23,12) Golay code is perfect with radius three: a segment (with zeros in front) and all words one bit
away decode to one or six codewords, and segments at most one bit apart have one in common. That
makes up to 18 keys a fingerprint; candidates that share a key are compared in full.

Copies fold into one fingerprint first. Keys held by more fingerprints than ``pair_limit`` are not
paired: there each fingerprint meets the words one bit away from it, and fingerprints that meet the
same word are tied to the least of them. Words in common are exactly what distance two means, so no
link is lost and no group is paired off. Links become components by alternating star contractions,
written to the shared folder after each round.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.common import LOWEST, by_name, by_place, order_id, slices, stored, utf8

SEED = 42
SHINGLE = 3
MAX_DISTANCE = 2
PAIR_LIMIT = 24
BLOCK_BYTES = 1 << 20
SEGMENTS = ((42, 22), (21, 21), (0, 21))
GOLAY = 0xC75  # fixed value: generator polynomial of the (23,12) code
_LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def word_blocks(text: bytes, overlap: int) -> Iterator[list[bytes]]:
    """The words of a text in blocks, each beginning with the last words of the one before."""
    at, carried = 0, []
    while at < len(text):
        end = min(at + BLOCK_BYTES, len(text))
        while end < len(text) and text[end] not in b" \t\n\x0b\f\r":
            stop = min((i for i in (text.find(s, end) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if i >= 0), default=len(text))
            end = stop
        carried += text[at:end].split()
        at = end
        if at >= len(text) or len(carried) > overlap:
            yield carried
            carried = carried[-overlap:] if overlap else []


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, each set if it is in over half of the shingles' hashes; 0 for a text without words."""
    text, ones, total = text.translate(_LOW), np.zeros(64, np.int64), 0
    digest = xxhash.xxh64_intdigest
    for words in word_blocks(text, shingle - 1):
        joined = b" ".join(words)
        if len(words) < shingle:
            if total or not words:
                continue
            hashes = [digest(joined, seed)]
        else:
            ends = np.cumsum([len(w) + 1 for w in words]).tolist()
            starts = [0, *ends]
            hashes = [digest(joined[a:b - 1], seed) for a, b in zip(starts, ends[shingle - 1:])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, text_hash and fingerprint (the 64 bits as a signed long) of each row; texts go no further."""
    names = ["doc_id", "text_hash", "fingerprint"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            marks = np.array([fingerprint(t, shingle, seed) for t in utf8(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names[:2]), pa.array(marks.view(np.int64))], names=names)

    rows = df.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("fingerprint", T.LongType())])
    return rows.mapInArrow(run, schema)


@cache
def syndromes() -> np.ndarray:
    """For each of the 2048 remainders, the error of at most three bits that leaves it."""
    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GOLAY << (bit - 11)
        return word

    single = [remainder(1 << i) for i in range(23)]
    errors = np.zeros(2048, np.int64)
    for a in range(23):
        for b in range(a, 23):
            for c in range(b, 23):
                places = {a, b, c}
                if a == b != c:
                    continue
                at = 0
                for p in places:
                    at ^= single[p]
                errors[at] = sum(1 << p for p in places)
    return errors


def codewords(segment: np.ndarray) -> np.ndarray:
    """Index (upper 12 bits) of the codeword nearest to each 23-bit word."""
    rest = segment.copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, GOLAY << (bit - 11), 0)
    return (segment ^ syndromes()[rest]) >> 11


def golay_keys(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and key of each fingerprint's different keys."""
    rows, keys = [], []
    parts = [(marks >> np.uint64(s) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in SEGMENTS]
    for j in range(3):
        whole, near = parts[j], parts[(j + 1) % 3]
        around = np.stack([codewords(near), *(codewords(near ^ (1 << b)) for b in range(23))], axis=1)
        around.sort(axis=1)
        first = np.ones(around.shape, bool)
        first[:, 1:] = around[:, 1:] != around[:, :-1]
        at, column = np.nonzero(first)
        rows.append(at)
        keys.append(j << 60 | whole[at] << 12 | around[at, column])
    return np.concatenate(rows), np.concatenate(keys)


def keyed(marks: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("fingerprint").to_numpy()
            for at in range(0, len(prints), 4096):
                part = prints[at: at + 4096]
                rows, keys = golay_keys(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], names=["key", "fingerprint"])

    return marks.select("fingerprint").mapInArrow(run, "key long, fingerprint long")


def links(marks: DataFrame, max_distance: int = MAX_DISTANCE, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Pairs (a > b) of different fingerprints that connect all those at most ``max_distance`` bits apart."""
    keys = stored(keyed(marks), "golay-keys")
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = stored(keys.join(sizes, "key"), "golay-shared")
    small = shared.filter(F.col("n") <= pair_limit).select("key", "fingerprint")
    left, right = small.withColumnRenamed("fingerprint", "a"), small.withColumnRenamed("fingerprint", "b")
    pairs = left.join(right, "key").filter("a > b").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)
    crowded = shared.filter(F.col("n") > pair_limit).select("fingerprint").distinct()
    return pairs.select("a", "b").unionByName(near_words(crowded, max_distance)).distinct()


def near_words(marks: DataFrame, max_distance: int) -> DataFrame:
    """Ties by a word one bit away: linear in the fingerprints however many lie close together."""
    masks = F.array(F.lit(0).cast("long"), *(F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(64)))
    words = marks.select("fingerprint", F.explode(masks).alias("mask")).select(
        "fingerprint", F.col("fingerprint").bitwiseXOR(F.col("mask")).alias("word"))
    if max_distance == 1:
        other = marks.select(F.col("fingerprint").alias("word"), F.col("fingerprint").alias("b"))
    else:
        other = words.groupBy("word").agg(F.min("fingerprint").alias("b"), F.max("fingerprint").alias("most")).filter(
            "b < most").select("word", "b")
    return words.join(other, "word").filter("fingerprint > b").select(F.col("fingerprint").alias("a"), "b")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (a > b): root is the least node of its component.

    Large stars tie each larger neighbour of a node to the least around it, small stars the smaller
    ones; both keep the components. When a round changes nothing, every node is tied to its root.
    """
    def sums(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = stored(edges, "edges")
    state = sums(edges)
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b")
        edges = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        before, state = state, sums(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def grouped(df: DataFrame, shingle: int, max_distance: int, seed: int, pair_limit: int) -> DataFrame:
    """doc_id, text_hash, fingerprint, root (of the component) and first (its least id) of each row."""
    if not 0 <= max_distance <= MAX_DISTANCE:
        raise ValueError(f"the keys find fingerprints up to {MAX_DISTANCE} bits apart, not {max_distance}")
    marked = stored(fingerprints(by_place(df, ("doc_id", "text"))[0], shingle, seed), "fingerprints")
    marks = marked.groupBy("fingerprint").agg(F.min(order_id()).alias("least"))
    rooted = marks.withColumn("root", F.col("fingerprint"))
    if max_distance:
        roots = components(links(marks, max_distance, pair_limit))
        rooted = marks.join(roots, marks.fingerprint == roots.node, "left").select(
            "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("least").alias("first"))
    return marked.join(rooted.join(firsts, "root").select("fingerprint", "root", "first"), "fingerprint")


def near_duplicates(df: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE, seed: int = SEED,
                    pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """doc_id, fingerprint (hex), component_id: the least doc_id linked to the row, itself included.

    Linked are rows whose fingerprints differ in at most ``max_distance`` bits (two at most here).
    Null and empty texts have the fingerprint zero and are linked like any other. Repeated rows give
    repeated rows. A null doc_id counts as the least of all and shows as null. An empty table gives
    no rows. Other columns, whatever their names, are not read.
    """
    first = F.when(F.col("first") > LOWEST, F.col("first"))
    return grouped(df, shingle, max_distance, seed, pair_limit).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), first.alias("component_id"))


def keep_one(df: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE, seed: int = SEED,
             pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """One row of each group: that of the least doc_id, then of the least text hash; columns as they are."""
    plain, names = by_place(df, ("doc_id", "text"))
    first = grouped(plain, shingle, max_distance, seed, pair_limit).groupBy("root").agg(
        F.min(F.struct(order_id().alias("id"), "text_hash")).alias("w")).select("w.id", "w.text_hash")
    tagged = plain.withColumns({"__id": order_id(), "__hash": F.xxhash64("text")})
    kept = tagged.join(first, (tagged["__id"] == first["id"]) & (tagged["__hash"] == first["text_hash"]), "left_semi")
    return by_name(kept.dropDuplicates(["__id", "__hash"]).select(*plain.columns), names)
