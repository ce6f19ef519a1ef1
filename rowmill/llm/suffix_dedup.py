"""Repeated substrings: difference-cover suffix sorting over the parts of texts that can repeat at all.

0. A text that a smaller document holds as a whole goes as a whole, and takes no further part.
1. Each window of 50 bytes has a minimizer, the least hash of the 24-byte strings in it. Equal windows
   have equal minimizers, so a minimizer seen in one document only rules its windows out. Texts lie in
   stored batches; minimizers are counted in shards, as sorted numbers with the batch they came from, and
   each batch is told which of its own several documents hold. Nothing that grows with the data goes to all tasks.
2. What is left is cut into runs of windows under one minimizer, which travel with their bytes: equal
   windows meet in one shard, where equal runs fold into one with the least document that holds it.
3. In each shard, of bounded bytes, the difference-cover algorithm sorts all suffixes: positions 1 and 2
   modulo 3 are sorted by triples and named, the names are sorted by the same algorithm until they
   differ, the positions 0 modulo 3 follow from their first symbol and the next rank, and both are
   merged. Neighbours whose first 50 bytes agree form a class; its least document is the one that keeps the bytes.
4. Minimizers with too many different runs for a shard are split into single windows, grouped by
   their bytes with partial aggregation.
5. Each occurrence of a run gets a bit for each of its windows that begins in a smaller document; one
   join by batch brings the bits to the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.llm.common import by_bytes, by_place, order_id, stored, utf8

LENGTH, GRAM = 50, 24
SPAN = LENGTH - GRAM + 1
BATCH_BYTES = 1 << 20
SHARD_BYTES = 2 << 20
HOT_BYTES = SHARD_BYTES // 4
SENT_HOT = SENT_COPIES = 1_000_000
COUNT_BYTES = 64 << 20
MOST_FREQUENT = 1000
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number whose order is that of the bytes."""
    n = len(data) - 7
    out = np.empty(max(n, 0), np.uint64)
    for s in range(8):
        part = np.frombuffer(data, ">u8", (len(data) - s) // 8, s) if len(data) - s >= 8 else []
        out[s::8] = part[: len(out[s::8])]
    return out


def minimizers(data: np.ndarray) -> np.ndarray:
    """The least hash of the 24-byte strings in each window of 50 bytes."""
    words = words_at(data)
    least = (words[:-16] * _A) ^ (words[8:-8] * _B) ^ (words[16:] * _C)
    least ^= least >> np.uint64(29)
    least *= _C
    least ^= least >> np.uint64(32)
    wide = 1
    while 2 * wide <= SPAN:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    return np.minimum(least[: len(least) - (SPAN - wide)], least[SPAN - wide:])


def runs(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of (row of a text, place, number of windows, minimizer, bytes of the batch, place in them)."""
    for start, end in by_bytes(texts, BATCH_BYTES):
        joined = b"".join(texts[start:end])
        sizes = np.array([len(t) for t in texts[start:end]])
        ends = np.cumsum(sizes)
        # A long text alone is looked at in slices that share the bytes of a window.
        for lo in range(0, max(1, len(joined) - LENGTH + 1), 4 * BATCH_BYTES):
            data = np.frombuffer(joined, np.uint8, min(len(joined) - lo, 4 * BATCH_BYTES + LENGTH - 1), lo)
            if len(data) < LENGTH:
                continue
            least = minimizers(data)
            place = np.arange(lo, lo + len(least))
            row = np.searchsorted(ends, place, side="right")
            valid = place + LENGTH <= ends[row]
            new = np.ones(len(least), bool)
            new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
            first = np.flatnonzero(new)
            since = np.arange(len(least)) - first[np.cumsum(new) - 1]
            new |= since % SPAN == 0
            at = np.flatnonzero(new)
            count = np.add.reduceat(valid.astype(np.int64), at)
            kept = count > 0
            at, count = at[kept], count[kept]
            yield row[at] + start, place[at] - (ends - sizes)[row[at]], count, least[at], data, at


def packed(numbers: np.ndarray) -> bytes:
    """The low 40 bits of sorted numbers, five bytes each."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").reshape(-1)


def batched(docs: DataFrame) -> DataFrame:
    """(batch, bytes, blob): rows in batches of about a megabyte of text, each a compressed Arrow stream.

    Stored, so that a batch holds the same rows whenever it is read; a copy travels without its text.
    """
    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            texts = utf8(batch.column("text"))
            for start, end in by_bytes(texts, BATCH_BYTES):
                part = batch.slice(start, end - start).drop_columns("text").append_column("text", pa.array(texts[start:end], pa.binary()))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                    out.write_batch(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([made], pa.int64()), pa.array([sum(map(len, texts[start:end]))], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                    names=["batch", "bytes", "blob"])
                made += 1

    return stored(docs.mapInArrow(put, "batch long, bytes long, blob binary"), "batches", compression="uncompressed")


def opened(batches: Iterator[pa.RecordBatch], other: str | None = None) -> Iterator[tuple[int, pa.RecordBatch, list | None]]:
    """(batch, its rows, what the column ``other`` holds for it) of rows made by ``batched``, one at a time."""
    for part in batches:
        for i, number in enumerate(part.column("batch").to_pylist()):
            rows = pa.ipc.open_stream(part.column("blob")[i].as_buffer()).read_next_batch()
            yield number, rows, part.column(other)[i].as_py() if other else None


def numbered(least: np.ndarray, shards: int) -> np.ndarray:
    """Shard and 40 bits of a minimizer. Shortening only joins minimizers, so none that repeats is missed."""
    return (least % np.uint64(shards)) << np.uint64(40) | (least >> np.uint64(24))


def repeated_minimizers(texts: DataFrame, shards: int) -> DataFrame:
    """(batch, known): for each batch of texts, which of its minimizers several documents hold, by shard."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows, _ in opened(batches):
            owner = rows.column("doc").to_numpy(zero_copy_only=False)
            parts = [(least, owner[row]) for row, _, _, least, _, _ in runs(rows.column("text").to_pylist())]
            if not parts:
                continue
            least, doc = (np.concatenate(x) for x in zip(*parts))
            number = numbered(least, shards)
            order = np.argsort(number, kind="stable")
            number, doc = number[order], doc[order]
            first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
            several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
            number = number[first]
            edges = np.arange(shards + 1, dtype=np.uint64) << np.uint64(40)
            held = [(packed(x), 5 * np.searchsorted(x, edges)) for x in (number[~several], number[several])]
            filled = np.flatnonzero(sum(np.diff(at) for _, at in held))
            cut = [pa.array([data[at[s]:at[s + 1]] for s in filled.tolist()], pa.binary()) for data, at in held]
            yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int64()), pa.array(np.full(len(filled), batch), pa.int64()), *cut],
                                             names=["shard", "batch", "one", "several"])

    def gather(table: pa.Table) -> pa.Table:
        held = [x for c in ("one", "several") for x in table.column(c).to_pylist()]
        number = unpacked(b"".join(held))
        sizes = np.array([len(x) // 5 for x in held])
        row = np.repeat(np.arange(len(held)) % table.num_rows, sizes)
        in_order = np.sort(number)
        common = np.union1d(in_order[1:][in_order[1:] == in_order[:-1]], number[sizes[:table.num_rows].sum():])
        keep = np.flatnonzero(holds(common, number))
        keep = keep[np.argsort(row[keep], kind="stable")]
        at, data = 5 * np.searchsorted(row[keep], np.arange(table.num_rows + 1)), packed(number[keep])
        numbers = [data[a:b] for a, b in zip(at.tolist(), at[1:].tolist())]
        out = pa.table([table.column("batch"), table.column("shard"), pa.array(numbers, pa.binary())], names=["batch", "shard", "numbers"])
        return out.filter(pa.array(np.diff(at) > 0))

    rows = texts.mapInArrow(count, "shard long, batch long, one binary, several binary")
    found = rows.groupBy("shard").applyInArrow(gather, "batch long, shard long, numbers binary")
    return found.groupBy("batch").agg(F.collect_list(F.struct("shard", "numbers")).alias("known"))


def holds(known: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Which numbers are among the known ones, which are sorted."""
    if not len(known):
        return np.zeros(len(numbers), bool)
    return known[np.minimum(np.searchsorted(known, numbers), len(known) - 1)] == numbers


def candidate_runs(texts: DataFrame, shards: int) -> DataFrame:
    """(batch, row, doc, place, least, content) of the runs whose minimizer several documents hold."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows, found in opened(batches, "known"):
            known = np.sort(np.concatenate([np.uint64(f["shard"]) << np.uint64(40) | unpacked(f["numbers"]) for f in found]))
            doc = rows.column("doc").to_numpy(zero_copy_only=False)
            for row, place, n, least, data, at in runs(rows.column("text").to_pylist()):
                keep = np.flatnonzero(holds(known, numbered(least, shards)))
                row, place, n, least, at = (x[keep] for x in (row, place, n, least, at))
                raw = data.tobytes()
                contents = [raw[a:a + k + LENGTH - 1] for a, k in zip(at.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), batch), pa.int64()), pa.array(row, pa.int64()), pa.array(doc[row]), pa.array(place, pa.int64()),
                     pa.array(least.view(np.int64)), pa.array(contents, pa.binary())], names=["batch", "row", "doc", "place", "least", "content"])

    known = repeated_minimizers(texts.select("batch", "blob"), shards)
    return texts.select("batch", "blob").join(known, "batch").mapInArrow(cut, "batch long, row long, doc long, place long, least long, content binary")


def sorted_places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of values, not below zero, in their order, and the values in that order; equal ones by place.

    Value and place share a word where they fit, as words are sorted much faster than places by their words.
    """
    bits = max(1, int(len(values) - 1).bit_length())
    if len(values) and int(values.max()) >> (63 - bits) == 0:
        word = np.sort(values << bits | np.arange(len(values)))
        return word & ((1 << bits) - 1), word >> bits
    order = np.argsort(values, kind="stable")
    return order, values[order]


def named(first: np.ndarray, last: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of (first, last), and their names: equal numbers for equal pairs, in their order."""
    if int(first.max(initial=0)) < (1 << 62) // base:
        order, held = sorted_places(first * base + last)
        new = held[1:] != held[:-1]
    else:
        by_last, _ = sorted_places(last)
        order, held = sorted_places(first[by_last])
        order = by_last[order]
        new = (held[1:] != held[:-1]) | (last[order[1:]] != last[order[:-1]])
    name = np.empty(len(order), np.int64)
    name[order] = np.concatenate([[0], np.cumsum(new)])
    return order, name


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order, by the difference cover {1, 2} modulo 3; symbols are above zero."""
    n = len(s)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    s = np.concatenate([s.astype(np.int64), np.zeros(3, np.int64)])
    base = int(s.max()) + 1
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    order, name = named(s[sample] * base + s[sample + 1], s[sample + 2], base)
    if int(name.max()) + 1 < len(name):
        order = suffix_array(name + 1)
    rank = np.zeros(n + 3, np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    zeros, wide = np.arange(0, n, 3), n + 3
    by_zero, zero = sorted_places(s[zeros] * wide + rank[zeros + 1])
    zeros = zeros[by_zero]
    in_order = sample[order]
    in_order = in_order[in_order < n]
    one, two = in_order[in_order % 3 == 1], in_order[in_order % 3 == 2]
    # One merge of sorted lists: how many suffixes of the sample come before each of the others.
    head = s[:n + 1] * base + s[1:n + 2]
    if base * base >= (1 << 62) // wide:
        head = named(head, np.zeros(len(head), np.int64), 1)[1]
    before = np.searchsorted(s[one] * wide + rank[one + 1], zero)
    before = before + np.searchsorted(head[two] * wide + rank[two + 2], head[zeros] * wide + rank[zeros + 2])
    out = np.empty(n, np.int64)
    at = np.arange(len(zeros)) + before
    out[at] = zeros
    rest = np.ones(n, bool)
    rest[at] = False
    out[rest] = in_order
    return out


def least_holders(contents: list[bytes], docs: np.ndarray) -> np.ndarray:
    """For each window of each content, in turn: the least document of all windows with equal bytes."""
    data = np.frombuffer(b"".join(contents), np.uint8)
    sizes = np.array([len(c) for c in contents])
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    window = np.arange(len(data)) - starts[owner] <= sizes[owner] - LENGTH
    order = suffix_array(data.astype(np.int64) + 1)
    order = order[window[order]]
    words = words_at(np.concatenate([data, np.zeros(8, np.uint8)]))
    new = np.zeros(len(order), bool)
    new[0] = True
    for shift in (*range(0, LENGTH - 7, 8), LENGTH - 8):
        part = words[order + shift]
        new[1:] |= part[1:] != part[:-1]
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(docs[owner[order]], first)
    out = np.zeros(len(data), np.int64)
    out[order] = least[np.cumsum(new) - 1]
    return out[window]


_MARKED = "batch long, row long, place long, mask long"


def shard_marks(table: pa.Table) -> pa.Table:
    """(batch, row, place, mask) of the runs of a shard: a bit for each window that a smaller document has."""
    names = ["batch", "row", "place"]
    folded = table.column("content").combine_chunks().dictionary_encode()
    run, contents, doc = folded.indices.to_numpy(), folded.dictionary.to_pylist(), table.column("doc").to_numpy()
    holder = np.full(len(contents), np.iinfo(np.int64).max)
    np.minimum.at(holder, run, doc)
    held = least_holders(contents, holder)
    count = np.array([len(c) - LENGTH + 1 for c in contents])
    start = (np.cumsum(count) - count)[run]
    mask = np.zeros(len(run), np.int64)
    for j in range(int(count.max())):
        has = count[run] > j
        mask[has] |= (held[start[has] + j] < doc[has]).astype(np.int64) << j
    keep = pa.array(mask != 0)
    return pa.table([*(table.column(c).filter(keep) for c in names), pa.array(mask[mask != 0])], names=[*names, "mask"])


def single_marks(found: DataFrame) -> DataFrame:
    """The same for runs of crowded minimizers: each window of a different run by itself."""
    folded = found.groupBy("least", "run").agg(F.first("content").alias("content"), F.min("doc").alias("first"), F.count("*").alias("n"))
    single = folded.select("least", "run", "n", "first", "content", F.explode(F.sequence(F.lit(0), F.octet_length("content") - LENGTH)).alias("j")).select(
        "least", "run", "n", "first", "j", F.substring("content", F.col("j") + 1, F.lit(LENGTH)).alias("window"))
    holder = single.groupBy("window").agg(F.min("first").alias("holder"))
    held = stored(single.join(holder, "window").groupBy("least", "run", "n").agg(F.array_sort(F.collect_list(F.struct("j", "holder"))).alias("held")), "holders")
    # Fewer than MOST_FREQUENT runs can each make up more than that part of all occurrences; these are sent to the tasks.
    frequent = F.col("n") * MOST_FREQUENT > (held.agg(F.sum("n")).first()[0] or 0)
    sent, rare = F.broadcast(held.filter(frequent).drop("n")), held.filter(~frequent).drop("n")
    bits = F.aggregate(F.transform("held", lambda h: F.when(h["holder"] < F.col("doc"), F.call_function(
        "shiftleft", F.lit(1).cast("long"), h["j"])).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, b: a + b)
    found, keys = found.drop("content"), ["least", "run"]
    both = found.join(sent, keys).unionByName(found.join(sent, keys, "left_anti").join(rare, keys))
    return both.select("batch", "row", "place", bits.alias("mask")).filter("mask != 0")


def marks(found: DataFrame, shard_bytes: int, hot_bytes: int, sent_hot: int) -> DataFrame:
    """(batch, row, place, mask): the windows of each run that also begin in a smaller document."""
    size = F.octet_length("content").cast("long")
    total = found.agg(F.sum(size)).first()[0] or 0
    hot = stored(found.groupBy("least").agg(F.sum(size).alias("bytes")).filter(F.col("bytes") > hot_bytes).select("least"), "crowded")
    few = hot.count() <= sent_hot
    shards = max(1, -(-total // shard_bytes))
    part = F.pmod(F.xxhash64("least"), F.lit(shards)).alias("part")
    sent = F.broadcast(hot) if few else hot
    cold = found.join(sent, "least", "left_anti").select("batch", "row", "doc", "place", "content", part)
    crowded = found.join(sent, "least", "left_semi").withColumn("run", F.xxhash64("content"))
    return cold.groupBy("part").applyInArrow(lambda t: shard_marks(t.drop_columns("part")), _MARKED).unionByName(single_marks(crowded))


def remove_repeats(df: DataFrame, shard_bytes: int = SHARD_BYTES, hot_bytes: int = HOT_BYTES, count_bytes: int = COUNT_BYTES,
                   sent_hot: int = SENT_HOT, sent_copies: int = SENT_COPIES) -> DataFrame:
    """doc_id, kept (bytes), n_bytes, n_removed, n_spans of each row's text without its repeats.

    A byte goes if a string of 50 bytes over it also starts in a row with a smaller doc_id; strings do not cross texts,
    and are judged on the texts as they came. A null text is empty. A null doc_id is smaller than all
    others. Rows that share a doc_id remove nothing from each other. Texts under 50 bytes stay whole, an
    empty table gives no rows, other columns, whatever their names, are not read.
    """
    df = by_place(df, ("doc_id", "text"))[0]
    # Whole texts fold by two hashes of different seeds, 128 bits in all.
    docs = df.select("doc_id", order_id().alias("doc"), F.xxhash64("text").alias("hash"), F.xxhash64(F.lit("wide"), "text").alias("wide"),
                     F.col("text").cast("string").alias("text"))
    copied = stored(docs.groupBy("hash", "wide").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last").select("hash", "wide", "first"), "copies")
    copied = F.broadcast(copied) if copied.count() <= sent_copies else copied
    is_copy = F.coalesce((F.col("doc") > F.col("first")) & (F.octet_length("text") >= LENGTH), F.lit(False))
    docs = docs.join(copied, ["hash", "wide"], "left").withColumn("copy", is_copy)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    texts = batched(docs.select("doc_id", "doc", "copy", size.alias("size"), F.when(~F.col("copy"), F.col("text")).alias("text")))
    total = texts.agg(F.sum("bytes")).first()[0] or 0
    shards = 1 << max(4, (total // count_bytes).bit_length())
    found = stored(candidate_runs(texts, shards), "candidates", compression="zstd")
    removed = marks(found, shard_bytes, hot_bytes, sent_hot)
    by_batch = removed.groupBy("batch").agg(F.collect_list(F.struct("row", "place", "mask")).alias("gone"))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, gone in opened(batches, "gone"):
            marked = {}
            for g in gone or ():
                marked.setdefault(g["row"], []).append((g["place"], g["mask"]))
            kept, counts = rows.column("text").to_pylist(), []
            for row, (size, copy) in enumerate(zip(rows.column("size").to_pylist(), rows.column("copy").to_pylist())):
                if copy or row not in marked:
                    counts.append((size, size, 1) if copy else (size, 0, 0))
                    continue
                text = kept[row]
                place, mask = np.array(marked[row]).T
                at, j = np.nonzero(mask[:, None] >> np.arange(SPAN) & 1)
                starts = place[at] + j
                edge = np.zeros(len(text) + 1, np.int64)
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + LENGTH, -1)
                covered = np.cumsum(edge[:-1]) > 0
                kept[row] = np.frombuffer(text, np.uint8)[~covered].tobytes()
                counts.append((size, int(covered.sum()), int((np.diff(covered.astype(np.int8), prepend=0) == 1).sum())))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(kept, pa.binary()), *(pa.array([c[i] for c in counts], pa.int64()) for i in range(3))],
                                             names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    schema = df.select("doc_id").schema.add("kept", "binary").add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
    return texts.select("batch", "blob").join(by_batch, "batch", "left").mapInArrow(strip, schema)
