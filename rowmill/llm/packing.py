"""Packing by best-fit decreasing: documents become pieces, pieces fill sequences of fixed length.

One scan encodes every text and writes a row per piece (full windows first, then the rest); texts
and ids go no further. The pieces, five numbers each, are dealt into groups of about equal size,
and each group is packed on its own: longest piece first, into the open sequence with the least
room that still takes it, which a segment tree over remaining capacities finds. Groups are large
enough that their few unfilled sequences hardly count, and their size does not grow with the input.
"""

from __future__ import annotations

import gc
import re
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import chain, filterfalse, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.llm.common import by_place, remembered, slices, spans, stored, trim
from rowmill.llm.tokens import BATCH_BYTES, JOINED, edges, encode

GROUP_PIECES, POOL_PIECES = 20_000, 400_000
# A run of these after a letter is a token run of its own; letters before LATIN_END are letters in every Unicode version in use.
SIGNS, LATIN_END = ".,;:!?#*$%&", "\u0250"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, salt long"
_PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_LINE = re.compile(r"(?<=\S)\n(?=\S)")
_WORD = re.compile(r"(?<=\S)(?= \S)")
# Every white space of Unicode, alone at an edge or in a run: such texts are cut one by one.
_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_ODD = f"^$|^{_BLANK}|{_BLANK}$|{_BLANK}{{2}}"
_SIGN, _END = frozenset(SIGNS), ("end",)


def cut_text(text: str) -> tuple[list[str], list[int]]:
    """Pieces of a text for a byte-level tokenizer that ties one space to the word after it, and which begin a line.

    A single space between two words may be cut before, a single line feed on both sides. The space in front of a
    piece, or the line feed in front of one that begins a line, is left out.
    """
    pieces, heads = [], []
    for line in _LINE.split(text):
        heads.append(len(pieces))
        first, *rest = _WORD.split(line)
        pieces.append(first)
        pieces += [w[1:] for w in rest]
    return pieces, heads


def cut_plain(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """The same for texts without runs or edges of white space, all at once: pieces, which begin a line, pieces a text."""
    lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    sizes = np.diff(lists.offsets.to_numpy())
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    # Between two pieces of a text stands one sign, a space or a feed.
    heads = np.ones(int(sizes.sum()), bool)
    inner = np.ones(len(heads), bool)
    inner[np.cumsum(sizes) - sizes] = False
    heads[inner] = data[(data == 32) | (data == 10)] == 10
    return lists.flatten(), heads, sizes


def encoded_words(path: str, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words with a space before each, one after another, and how many each has.

    Words of letters are encoded many to a line and parted at the ids that begin a word; a line whose marks do not match
    its words is encoded word by word, as are all other words.
    """
    _, marked = edges(path)
    plain = [i for i, w in enumerate(words) if w.isalpha()]
    order, ids, lens = [], [], []
    rest = [i for i, w in enumerate(words) if not w.isalpha()]
    lines = [plain[at:at + JOINED] for at in range(0, len(plain), JOINED)]
    for line, found in zip(lines, encode(path, [" " + " ".join([words[i] for i in line]) for line in lines])):
        found = np.array(found, np.uint32)
        at = np.flatnonzero(marked[np.minimum(found, len(marked) - 1)])
        if len(at) != len(line) or at[0] or found.max() >= len(marked):
            rest += line
            continue
        order += line
        ids.append(found)
        lens.append(np.diff(at, append=len(found)))
    for i, found in zip(rest, encode(path, [f" {words[i]}" for i in rest])):
        order.append(i)
        ids.append(np.array(found, np.uint32))
        lens.append(np.array([len(found)]))
    ids, lens, order = np.concatenate(ids), np.concatenate(lens), np.array(order)
    # Back into the order of the words.
    turn = np.argsort(order)
    starts, wide = (np.cumsum(lens) - lens)[turn], lens[turn]
    return ids[np.repeat(starts - (np.cumsum(wide) - wide), wide) + np.arange(len(ids))], wide


class Pool:
    """Token ids of pieces, remembered by a worker in one array; a piece is a place in it.

    ``words`` have a space before them, ``heads`` nothing. Documents are put together from the places of their
    pieces by numpy, a batch at a time. A full pool keeps the pieces that came again after the batch that
    brought them; most pieces come once.
    """

    def __init__(self, path: str, end_id: int, most: int | None = None):
        self.path, self.end, self.most = path, np.array([end_id], np.uint32), most or POOL_PIECES
        self.clear()

    def clear(self) -> None:
        self.words: dict[str, int] = {}
        self.heads: dict[str, int] = {}
        self.ids, self.starts, self.lens = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.again = np.zeros(0, bool)
        self.add(self.heads, [_END], self.end, np.array([1]))

    def shrink(self) -> None:
        """Forget the pieces that did not come again, or all if even the others fill most of the pool."""
        self.again[self.heads[_END]] = True
        kept = np.flatnonzero(self.again)
        if 4 * len(kept) > 3 * self.most:
            self.clear()
            return
        place = (np.cumsum(self.again) - 1).tolist()
        self.words, self.heads = ({p: place[i] for p, i in known.items() if self.again[i]} for known in (self.words, self.heads))
        self.ids, self.lens = self.gathered(kept)
        self.starts, self.again = np.cumsum(self.lens) - self.lens, np.zeros(len(kept), bool)

    def add(self, known: dict, pieces: list, ids: np.ndarray, lens: np.ndarray) -> None:
        known.update(zip(pieces, range(len(self.lens), len(self.lens) + len(lens))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lens) - lens])
        self.lens, self.ids = np.concatenate([self.lens, lens]), np.concatenate([self.ids, ids])
        self.again = np.concatenate([self.again, np.zeros(len(lens), bool)])

    def gathered(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces one after another, and how many each has."""
        lens = self.lens[places]
        return self.ids[np.repeat(self.starts[places] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())], lens

    def places(self, known: dict, pieces: list, learn: Callable[[list], None]) -> np.ndarray:
        found = np.fromiter(map(known.get, pieces, repeat(-1)), np.int64, len(pieces))
        self.again[found[found >= 0]] = True
        missing = np.flatnonzero(found < 0).tolist()
        if missing:
            new = [pieces[i] for i in missing]
            learn(list(dict.fromkeys(new)))
            found[missing] = [known[w] for w in new]
        return found

    def learn_heads(self, pieces: list[str]) -> None:
        new = encode(self.path, pieces)
        self.add(self.heads, pieces, np.concatenate([np.array(x, np.uint32) for x in new]), np.array([len(x) for x in new]))

    def learn_words(self, pieces: list[str]) -> None:
        """A run of signs after a letter is a token run of its own, so it is cut off and the word before it encoded once."""
        signed = [(w, s) for w, s in ((w, w.rstrip(SIGNS)) for w in pieces if w[-1:] in _SIGN) if s and s[-1] < LATIN_END and s[-1].isalpha()]
        cut = {w for w, _ in signed}
        new = list(filterfalse(self.words.__contains__, {s for _, s in signed}.union(w for w in pieces if w not in cut)))
        if new:
            self.add(self.words, new, *encoded_words(self.path, new))
        if signed:
            pairs = np.empty(2 * len(signed), np.int64)
            pairs[::2] = [self.words[s] for _, s in signed]
            pairs[1::2] = self.places(self.heads, [w[len(s):] for w, s in signed], self.learn_heads)
            ids, lens = self.gathered(pairs)
            self.add(self.words, [w for w, _ in signed], ids, lens.reshape(-1, 2).sum(1))

    def joined(self, pieces: pa.StringArray, heads: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts given by their pieces, each with the end id, one after another, and where each text ends."""
        coded = pieces.dictionary_encode()
        codes, names = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()

        def placed(known: dict, which: np.ndarray, learn: Callable[[list], None]) -> np.ndarray:
            used = np.flatnonzero(np.bincount(codes[which], minlength=len(names)))
            out = np.zeros(len(names), np.int64)
            out[used] = self.places(known, [names[i] for i in used.tolist()], learn)
            return out

        places = placed(self.words, ~heads, self.learn_words)[codes]
        places[heads] = placed(self.heads, heads, self.learn_heads)[codes[heads]]
        ends = np.cumsum(sizes)
        feeds = heads.copy()
        feeds[ends - sizes] = False
        feed, end = self.places(self.heads, ["\n"], self.learn_heads)[0], self.heads[_END]
        # Where each piece goes once a feed stands before those that begin a further line, and the end id after each text.
        at = np.arange(len(places)) + np.cumsum(feeds) + np.repeat(np.arange(len(sizes)), sizes)
        whole, last = np.full(len(places) + int(feeds.sum()) + len(sizes), feed), at[ends - 1] + 1
        whole[at], whole[last] = places, end
        ids, lens = self.gathered(whole)
        return ids, np.cumsum(lens)[last]

    def encoded(self, texts: pa.StringArray) -> list[np.ndarray]:
        """The ids of each text, with the end id."""
        if len(self.lens) > self.most:
            self.shrink()
        out: list = [None] * len(texts)
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        for rows in (np.flatnonzero(odd), np.flatnonzero(~odd)):
            if not len(rows):
                continue
            part = texts.take(pa.array(rows))
            if odd[rows[0]]:
                cuts = [cut_text(t) for t in part.to_pylist()]
                sizes = np.array([len(pieces) for pieces, _ in cuts])
                heads = np.zeros(int(sizes.sum()), bool)
                heads[np.concatenate([np.array(h) + at for (_, h), at in zip(cuts, np.cumsum(sizes) - sizes)])] = True
                ids, ends = self.joined(pa.array(list(chain.from_iterable(p for p, _ in cuts)), pa.string()), heads, sizes)
            else:
                ids, ends = self.joined(*cut_plain(part))
            for row, own in zip(rows.tolist(), np.split(ids, ends[:-1])):
                out[row] = own
        return out


def tightest(tree: list[int], size: int, need: int) -> int | None:
    """The least capacity of at least ``need`` with an open sequence, in a tree of counts."""
    i = need + size
    if not tree[i]:
        while i > 1 and (i % 2 or not tree[i + 1]):
            i //= 2
        if i <= 1:
            return None
        i += 1
        while i < size:
            i *= 2
            if not tree[i]:
                i += 1
    return i - size


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, given longest first."""
    size = 1 << capacity.bit_length()
    tree, open_at = [0] * (2 * size), [[] for _ in range(capacity + 1)]

    def add(room: int, by: int) -> None:
        i = room + size
        while i:
            tree[i] += by
            i //= 2

    bins, offsets, made = [], [], 0
    for length in lengths:
        room = tightest(tree, size, length)
        if room is None:
            bin_, room, made = made, capacity, made + 1
        else:
            bin_ = open_at[room].pop()
            add(room, -1)
        bins.append(bin_)
        offsets.append(capacity - room)
        if room > length:
            open_at[room - length].append(bin_)
            add(room - length, 1)
    return bins, offsets


@contextmanager
def resting_collector() -> Iterator[None]:
    """Without searches for cycles, of which nothing inside makes any: each would walk through all remembered words."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def pieces(df: DataFrame, path: str, window: int, end_id: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A row per piece: full windows of a document's ids, then what is left of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, salt = remembered(("ids", path, end_id), lambda: Pool(path, end_id)), 0
        for batch in slices(batches, keep=True):
            texts = pc.fill_null(batch.column(text), "")
            keys, rows = batch.column(key).to_pylist(), []
            for start, end in spans(pc.binary_length(texts).to_numpy(), BATCH_BYTES):
                with resting_collector():
                    found = pool.encoded(texts.slice(start, end - start))
                for doc, ids in zip(keys[start:end], found):
                    for at in range(0, len(ids), window):
                        part = ids[at:at + window]
                        rows.append((doc, at, len(part), zlib.crc32(part.astype("<u4").tobytes()), len(ids), salt))
                        salt += 1
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt"])
        trim()

    df = by_place(df, (key, text))[0]
    return df.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text)).mapInArrow(run, _PIECES)


def pack(df: DataFrame, path: str, window: int = 2048, end_id: int = 1, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Every token id of ``df``'s texts in one piece of one sequence of at most ``window`` ids.

    A null or empty text is the end id alone, one piece of length one. Rows are packed one by one, so
    repeated rows and ids, and null ids, give pieces of their own. Only doc_id and text are read; other
    columns, whatever their names, play no part. An empty table gives no rows. Pieces of equal length
    are taken by doc_id and start, so the same table is packed alike.
    """
    cut = stored(pieces(df, path, window, end_id), "pieces")
    groups = max(1, -(-cut.count() // group_pieces))

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("salt", "ascending")])
        bins, offsets = best_fit(table.column("length").to_pylist(), window)
        base = table.column("part")[0].as_py() << 32
        kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        return pa.table([*(table.column(n) for n in kept), pa.array([base + b for b in bins], pa.int64()),
                         pa.array(offsets, pa.int64())], names=[*kept, "sequence_id", "offset"])

    part = F.pmod(F.xxhash64("doc_id", "start", "salt"), F.lit(groups)).alias("part")
    return cut.select("*", part).groupBy("part").applyInArrow(fill, _PACKED)
