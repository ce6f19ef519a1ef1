"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a few figures (shares of signs, capitals, digits, repeated words and lines, lengths), and each
figure a bin between edges that are quantiles over all texts. The model is a lookup table per figure and a
smaller one per chosen pair of figures. Tables are learned by boosting in turns: a round visits every
figure, fits one shallow tree to the gradient in its bins and adds a part of it to the table; then the pairs whose
residuals a tree over two figures explains best get tables of their own, in the same way. A score is the
logistic of an offset plus one entry of each table, so scoring adds up bins by numpy and every score
can be taken apart.

Texts are read once, in one scan that leaves only the figures. Tables are fitted on the driver from a
bounded sample of the labelled rows (``sample_rows``, a parameter); everything else covers all rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.common import by_place, order_id, slices, stored, utf8
from rowmill.llm.toxicity import held_out

SAMPLE_ROWS = 40_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, LEAVES, RIDGE, LEAST = 120, 60, 0.15, 4, 1.0, 0.5
_CLASSES = {
    "digits": b"0123456789", "capitals": bytes(range(65, 91)), "small": bytes(range(97, 123)), "stops": b".,;:", "shouts": b"!?",
    "signs": b"#*$%&|<>", "brackets": b"()[]{}/\\_=+@~^", "quotes": b"'\"`-", "blanks": b" \t\r\v\f", "feeds": b"\n",
}
FEATURES = (*_CLASSES, "other_bytes", "bytes", "words", "word_bytes", "line_words", "own_words", "own_pairs", "own_lines",
            "repeats", "shouted", "ended", "worst_line")
_SIGNED = re.compile(rb"[#*$%&|<>]|!!")


def figures(text: bytes) -> list[float]:
    """The figures of a text, in the order of ``FEATURES``; shares of nothing are zero."""
    size, words, lines = len(text), text.split(), text.split(b"\n")
    n, out = len(words), []
    for marks in _CLASSES.values():
        out.append(size - len(text.translate(None, marks)))
    out.append(size - sum(out))
    out = [v / max(1, size) for v in out]
    spoken = [line for line in lines if line]
    worst = max((len(_SIGNED.findall(line)) / (1 + line.count(b" ")) for line in spoken), default=0.0)
    return [*out, np.log1p(size), np.log1p(n), (sum(map(len, words))) / max(1, n), n / max(1, len(spoken)), len(set(words)) / max(1, n),
            len(set(zip(words, words[1:]))) / max(1, n - 1), len(set(spoken)) / max(1, len(spoken)), sum(map(eq, words, words[1:])) / max(1, n),
            sum(map(bytes.isupper, words)) / max(1, n), len(_SIGNED.findall(text)) / max(1, n), worst]


def described(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id and ``figures`` of each row's text; a null text is empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = np.array([figures(t) for t in utf8(batch.column("text"))], np.float32).reshape(-1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, len(FEATURES), dtype=np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "figures"])

    own = by_place(docs, (key, text))[0].select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return own.mapInArrow(run, own.select("doc_id").schema.add("figures", T.ArrayType(T.FloatType())))


@dataclass
class Model:
    """Tables of log-odds. ``edges`` part a figure into bins; a pair's table is by the coarse bins of both figures."""
    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    offset: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, values: np.ndarray) -> np.ndarray:
        """The bin of each figure, a row per text."""
        return np.stack([np.searchsorted(e, values[:, i], side="right") for i, e in enumerate(self.edges)], axis=1)

    def log_odds(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.offset)
        for i, table in enumerate(self.tables):
            total += table[bins[:, i]]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[self.coarse[i][bins[:, i]], self.coarse[j][bins[:, j]]]
        return total

    def scores(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(self.bins(values)), -35, 35)))


def _gain(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return gradient * gradient / (weight + RIDGE)


def _cut(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, int]:
    """The best place to cut a range of bins in two, and what it gains."""
    left_g, left_w = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    all_g, all_w = gradient.sum(), weight.sum()
    value = _gain(left_g, left_w) + _gain(all_g - left_g, all_w - left_w) - _gain(all_g, all_w)
    value[(left_w < LEAST) | (all_w - left_w < LEAST)] = -np.inf
    at = int(np.argmax(value)) if len(value) else 0
    return (float(value[at]), at + 1) if len(value) else (-np.inf, 0)


def shallow_tree(gradient: np.ndarray, weight: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Leaf values per bin of a tree of up to ``leaves`` leaves, grown by the best cut of any leaf."""
    parts = [(0, len(gradient))]
    cuts = [_cut(gradient, weight)]
    while len(parts) < leaves:
        best = max(range(len(parts)), key=lambda i: cuts[i][0])
        gain, at = cuts[best]
        if gain <= 1e-9:
            break
        a, b = parts[best]
        parts[best:best + 1] = [(a, a + at), (a + at, b)]
        cuts[best:best + 1] = [_cut(gradient[a:a + at], weight[a:a + at]), _cut(gradient[a + at:b], weight[a + at:b])]
    out = np.empty(len(gradient))
    for a, b in parts:
        out[a:b] = gradient[a:b].sum() / (weight[a:b].sum() + RIDGE)
    return out


def pair_tree(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best tree that cuts one figure and then, on each side, the other."""
    best, out = 0.0, np.zeros(gradient.shape)
    for flip in (False, True):
        g, w = (gradient.T, weight.T) if flip else (gradient, weight)
        for at in range(1, len(g)):
            total, values = -_gain(g.sum(), w.sum()), np.empty(g.shape)
            for rows in (slice(0, at), slice(at, len(g))):
                gain, cut = _cut(g[rows].sum(0), w[rows].sum(0))
                for columns in ((slice(0, cut), slice(cut, None)) if gain > 0 else (slice(None),)):
                    total += _gain(g[rows, columns].sum(), w[rows, columns].sum())
                    values[rows, columns] = g[rows, columns].sum() / (w[rows, columns].sum() + RIDGE)
            if total > best + 1e-12:
                best, out = total, (values.T if flip else values).copy()
    return float(best), out


def fit(values: np.ndarray, label: np.ndarray, edges: list[np.ndarray], pairs: int = PAIRS) -> Model:
    """Tables from the figures and labels (0 or 1) of some rows; without rows of both labels only the offset."""
    sizes = [len(e) + 1 for e in edges]
    coarse = [np.arange(s) * min(PAIR_BINS, s) // s for s in sizes]
    n, up = len(label), int(label.sum())
    model = Model(edges, coarse, float(np.log((up + 0.5) / (n - up + 0.5))))
    model.tables = [np.zeros(s) for s in sizes]
    if up in (0, n):
        return model
    bins = model.bins(values)
    odds = np.full(n, model.offset)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(odds, -35, 35)))
        return label - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i, size in enumerate(sizes):
            if size > 1:
                g, w = residual()
                step = RATE * shallow_tree(np.bincount(bins[:, i], g, size), np.bincount(bins[:, i], w, size))
                model.tables[i] += step
                odds += step[bins[:, i]]
    g, w = residual()

    def cells(i: int, j: int) -> tuple[np.ndarray, tuple[int, int]]:
        shape = (int(coarse[i][-1]) + 1, int(coarse[j][-1]) + 1)
        return coarse[i][bins[:, i]] * shape[1] + coarse[j][bins[:, j]], shape

    def by_cell(v: np.ndarray, cell: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
        return np.bincount(cell, v, shape[0] * shape[1]).reshape(shape)

    gains = []
    for i, j in combinations([i for i, s in enumerate(sizes) if s > 1], 2):
        cell, shape = cells(i, j)
        gains.append((pair_tree(by_cell(g, cell, shape), by_cell(w, cell, shape))[0], i, j))
    model.pairs = [(i, j) for gain, i, j in sorted(gains, key=lambda x: (-x[0], x[1:]))[:pairs] if gain > 0]
    held = [cells(i, j) for i, j in model.pairs]
    model.pair_tables = [np.zeros(shape) for _, shape in held]
    for _ in range(PAIR_ROUNDS if held else 0):
        for table, (cell, shape) in zip(model.pair_tables, held):
            g, w = residual()
            step = RATE * pair_tree(by_cell(g, cell, shape), by_cell(w, cell, shape))[1]
            table += step
            odds += step.reshape(-1)[cell]
    return model


def quantiles(described_rows: DataFrame, bins: int = BINS) -> list[np.ndarray]:
    """Edges of about equally filled bins for each figure, over all rows."""
    shares = [(i + 1) / bins for i in range(bins - 1)]
    found = described_rows.agg(*[F.percentile_approx(F.col("figures")[i], shares, 2000).alias(f"q{i}") for i in range(len(FEATURES))]).first()
    # A value on an edge belongs to the bin above; the least value makes no edge, the next float does.
    return [np.unique(np.nextafter(np.array(q or [], np.float32), np.float32(np.inf))) for q in found]


def train(rows: DataFrame, labels: DataFrame, label: str = "quality", parts: int = 5, part: int = 0, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on up to ``sample_rows`` labelled rows that are not held out, the first by hashed id."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id"), parts, part))
    single = known.groupBy(order_id().alias("doc")).agg(F.max(F.col(label).cast("int")).alias("label"))
    chosen = single.orderBy(F.xxhash64("doc"), "doc").limit(sample_rows)
    sample = rows.filter(F.col("doc_id").isNotNull()).withColumn("doc", order_id()).join(F.broadcast(chosen), "doc")
    found = sample.select("doc", "label", "figures").orderBy(F.xxhash64("doc"), "doc", "figures").limit(sample_rows).toPandas()
    values = np.array(found["figures"].tolist(), np.float32).reshape(-1, len(FEATURES))
    return fit(values, found["label"].to_numpy(np.int64), quantiles(rows))


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", parts: int = 5, part: int = 0,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score (0 to 1, the chance of label 1) and ``reasons``: the figures that moved the score, strongest first.

    Learns from labels of rows that are not held out; ids, languages and sources play no part. A null or empty text
    has figures of zero and is scored like any other. Of repeated labels the larger holds; repeated rows are scored one by
    one; a row with a null id is scored and teaches nothing. Without labels of both kinds every score is the base rate
    (a half where there are none). An empty table gives no rows. Other columns are not read.
    """
    rows = stored(described(docs), "figures")
    shared = docs.sparkSession.sparkContext.broadcast(train(rows, labels, label, parts, part, sample_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array(FEATURES, object)
        for batch in slices(batches, 20_000):
            values = batch.column("figures").flatten().to_numpy().reshape(-1, len(FEATURES))
            bins = model.bins(values)
            chance = 1 / (1 + np.exp(-np.clip(model.log_odds(bins), -35, 35)))
            share = np.abs(np.stack([table[bins[:, i]] for i, table in enumerate(model.tables)], axis=1))
            top = np.argsort(-share, axis=1, kind="stable")[:, :3]
            said = [names[t[s > 0.05]].tolist() for t, s in zip(top, np.take_along_axis(share, top, 1))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(chance), pa.array(said, pa.list_(pa.string()))], names=["doc_id", "score", "reasons"])

    scored = rows.mapInArrow(run, rows.select("doc_id").schema.add("score", "double").add("reasons", T.ArrayType(T.StringType())))
    return scored.select("doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"), "score", "reasons")
