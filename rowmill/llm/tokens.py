"""Token counts: batch encoding in Arrow functions that return lengths only.

A text is cut at safe boundaries, where no token can reach across, so the count of a text is the sum
over its pieces. Pieces repeat, so a batch of about equal bytes sends each new piece to the encoder
once and the worker remembers lengths, up to a number of pieces after which it forgets them all.
No shuffle: the scan cuts its input by bytes, and each row stays in its task.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.common import by_bytes, by_name, by_place, remembered, utf8

BATCH_BYTES = 2 * 1024 * 1024
REMEMBERED = 300_000
JOINED = 256
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_LOW = bytes.maketrans(UPPER, LOWER)
_STEM = re.compile(rb"^.*[A-Za-z](?=[.,]$)", re.S)
_LOADED: dict = {}


def tokenizer(path: str):
    """One tokenizer per worker process; its own threads would compete with Spark's tasks."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(path)
        loaded.no_truncation()
        loaded.no_padding()
        _LOADED[path] = loaded
    return _LOADED[path]


def encode(path: str, pieces: list[str]) -> list[list[int]]:
    return [e.ids for e in tokenizer(path).encode_batch_fast(pieces, add_special_tokens=False)]


class Memory(dict):
    """Piece to value, filled by the batch and emptied when it holds too many pieces."""

    def __init__(self, values: Callable[[Memory, list], Iterable], most: int = REMEMBERED):
        super().__init__()
        self.values_of, self.most = values, most

    def unknown(self, pieces: Iterable) -> list:
        """A set minus the keys would walk through all keys."""
        return list(filterfalse(self.__contains__, pieces))

    def learn(self, lists: list[list]) -> None:
        new = set(self.unknown(set().union(*lists)))
        if new and len(self) + len(new) > self.most:
            self.clear()
            new = set().union(*lists)
        if new:
            new = list(new)
            self.update(zip(new, self.values_of(self, new)))


def memory(kind: str, path: str, values: Callable) -> Memory:
    """What a worker remembers outlives its tasks."""
    return remembered((kind, path), lambda: Memory(values))


def edges(path: str) -> tuple[bool, np.ndarray]:
    """Whether a vocabulary marks where words end (else where a space begins one), and its marked ids."""
    if (path, "edges") not in _LOADED:
        vocab = tokenizer(path).get_vocab(with_added_tokens=False)
        ends = any(t.endswith("</w>") for t in vocab)
        marked = np.zeros(max(vocab.values()) + 1, bool)
        marked[[i for t, i in vocab.items() if (t.endswith("</w>") if ends else t.startswith("Ġ"))]] = True
        _LOADED[path, "edges"] = ends, marked
    return _LOADED[path, "edges"]


def ids_of_words(path: str, words: list[str]) -> list[bytes]:
    """Ids, four bytes each, of each word with a space before it. Words of letters are encoded many to a
    line and parted at the marked ids; a line whose marks do not match its words is encoded word by word."""
    ends, marked = edges(path)
    out: list = [None] * len(words)
    plain = [i for i, w in enumerate(words) if w.isalpha()]
    rest = [i for i, w in enumerate(words) if not w.isalpha()]
    lines = [plain[at:at + JOINED] for at in range(0, len(plain), JOINED)]
    for line, ids in zip(lines, encode(path, ["".join(f" {words[i]}" for i in line) for line in lines])):
        ids = np.array(ids, "<u4")
        known = ids < len(marked)
        at = np.flatnonzero(marked[np.where(known, ids, 0)])
        if len(at) != len(line) or not known.all() or not (at[-1] == len(ids) - 1 if ends else at[0] == 0):
            rest += line
            continue
        cuts, raw = (4 * (at + ends)).tolist(), ids.tobytes()
        cuts = [0, *cuts] if ends else [*cuts, len(raw)]
        for i, a, b in zip(line, cuts, cuts[1:]):
            out[i] = raw[a:b]
    for i, ids in zip(rest, encode(path, [f" {words[i]}" for i in rest])):
        out[i] = np.array(ids, "<u4").tobytes()
    return out


def word_counts(path: str) -> Callable[[Memory, list[bytes]], Iterable[int]]:
    """Counts of new words. A full stop or comma after an ASCII letter is a token of its own, and ASCII
    capitals count like small letters where no special token's string can be meant."""
    def values(known: Memory, words: list[bytes]) -> Iterator[int]:
        stems = []
        for word in words:
            found = _STEM.match(word)
            stem = found[0] if found else word
            stems.append(stem if b"<|" in stem else stem.translate(_LOW))
        new = known.unknown(set(stems))
        known.update(zip(new, (len(ids) // 4 for ids in ids_of_words(path, [w.decode() for w in new]))))
        return (known[s] + (len(w) - len(s)) for s, w in zip(stems, words))
    return values


def count_tokens(df: DataFrame, path: str, text: str = "text", whole: bool = False) -> DataFrame:
    """``df`` without its text, and ``n_bytes``, ``n_tokens`` of the text as the tokenizer gives them.

    The cuts (ASCII white space, and a last full stop or comma) are safe for tokenizers that fold case,
    drop white space and take runs of letters and of signs apart. For others set ``whole``: the
    texts then go to the encoder uncut. A null or empty text has no bytes and no tokens. A text
    without any white space is one piece, however long. Rows are independent, so repeated rows and
    ids, null ids and an empty table need no rule. Other columns pass through; a column that is
    already named n_bytes or n_tokens is replaced.
    """
    plain, outer = by_place(df, (text,), ("n_bytes", "n_tokens"))
    kept = [f for f in plain.schema.fields if f.name != text]
    schema = T.StructType([*kept, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    names = [f.name for f in kept]

    def lengths(known: Memory, texts: list[bytes]) -> list[int]:
        return [len(ids) for ids in encode(path, [t.decode() for t in texts])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Memory(lengths, most=0) if whole else memory("counts", path, word_counts(path))
        for batch in batches:
            texts, counts = utf8(batch.column("__text")), []
            for start, end in by_bytes(texts, BATCH_BYTES):
                lists = [[t] if whole else t.split() for t in texts[start:end]]
                known.learn(lists)
                counts += [sum(map(known.__getitem__, pieces)) for pieces in lists]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(counts, pa.int64())], names=[*names, "n_bytes", "n_tokens"])

    return by_name(plain.select(*names, F.col(f"`{text}`").alias("__text")).mapInArrow(run, schema), outer)
