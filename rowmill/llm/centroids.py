"""Centroid clustering by a vantage-point tree over the centroids, on integers throughout.

A vector's components become integers, floor(scale * x), so distances and means are exact and the same on
every machine. Each round builds a vantage-point tree over the centroids on the driver and broadcasts it
(its size is that of the centroids, whatever the input). In the tasks every vector searches the tree best
first: the open node with the least bound on its distance comes next, an inner node measures the vantage point
and bounds its two halves by the triangle inequality, a leaf measures its centroids, and a search ends
when the least bound exceeds the best distance so far. The radius is inclusive, so a centroid as near as
the best one is still seen and the smaller number wins. The searches of a batch advance together, step by
step, each with its own queue. Tasks return sums per centroid; vectors are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.common import by_place, stored

# Beyond this a squared distance of 64 components would not fit 64 bits.
MOST = 1 << 27
LEAF, QUEUE_BYTES = 2, 32 << 20
# Bounds are doubles and may err by a few units in the last place; this keeps every pruning on the safe side.
SLACK = 1e-12


@dataclass
class Clusters:
    """``assigned``: vec_id, cluster, distance (squared); the final ``centroids``; ``inertia`` of each (summed distances)."""
    assigned: DataFrame
    centroids: list[tuple[int, ...]]
    inertia: list[int]


@dataclass
class Node:
    """An inner node has a ``point`` and two ``halves`` (node, least and greatest distance from the point); a leaf has ``ids``."""
    point: int = -1
    halves: tuple = ()
    ids: tuple = ()


def squared(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    away = vectors - point
    return np.einsum("ij,ij->i", away, away)


def vantage_tree(centroids: np.ndarray) -> list[Node]:
    """Nodes of the tree, the root first. Halves are equal in number, so equal centroids do no harm."""
    nodes: list[Node] = []

    def add(ids: np.ndarray) -> int:
        at = len(nodes)
        nodes.append(Node(ids=tuple(ids.tolist())))
        if len(ids) > LEAF:
            # A point at the edge of its group splits it best.
            point = ids[np.argmax(squared(centroids[ids], centroids[ids[0]]))]
            rest = ids[ids != point]
            away = np.sqrt(squared(centroids[rest], centroids[point]))
            rest, away = rest[np.argsort(away, kind="stable")], np.sort(away)
            cuts = [(rest[:len(rest) // 2], away[:len(rest) // 2]), (rest[len(rest) // 2:], away[len(rest) // 2:])]
            nodes[at] = Node(int(point), tuple((add(part), float(d[0]), float(d[-1])) for part, d in cuts))
        return at

    if len(centroids):
        add(np.arange(len(centroids)))
    return nodes


def nearest(nodes: list[Node], centroids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each vector (the smallest of equals) and the squared distance."""
    n = len(vectors)
    label, best = np.full(n, len(centroids), np.int64), np.full(n, np.iinfo(np.int64).max, np.int64)
    bound = np.full((n, len(nodes)), np.inf)
    bound[:, 0] = 0.0
    live = np.arange(n)

    def measure(rows: np.ndarray, number: int) -> np.ndarray:
        found = squared(vectors[rows], centroids[number])
        closer = (found < best[rows]) | ((found == best[rows]) & (number < label[rows]))
        best[rows[closer]], label[rows[closer]] = found[closer], number
        return found

    while len(live):
        node = bound[live].argmin(1)
        low = bound[live, node]
        open_ = (low <= np.sqrt(best[live].astype(np.float64))) & np.isfinite(low)
        live, node, low = live[open_], node[open_], low[open_]
        bound[live, node] = np.inf
        for at in np.unique(node):
            rows, under, here = live[node == at], low[node == at], nodes[at]
            for number in here.ids if not here.halves else ():
                measure(rows, number)
            if here.halves:
                away = np.sqrt(measure(rows, here.point).astype(np.float64))
                for half, least, most in here.halves:
                    apart = np.maximum(least - away, away - most) - SLACK * (away + most)
                    bound[rows, half] = np.maximum(under, apart)
    return label, best


def vectors(df: DataFrame, dims: int, scale: int, vector: str, key: str) -> DataFrame:
    """(vec_id, v): the vectors that can be clustered, as integers."""
    df = by_place(df, (key, vector))[0]
    x = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))
    whole = F.transform(x, lambda v: F.when(F.abs(v) * scale < MOST, F.floor(v * scale).cast("int")).otherwise(
        F.raise_error(F.lit(f"a component times {scale} lies beyond {MOST}: its distances would not fit 64 bits")).cast("int")))
    return df.filter(F.coalesce((F.size(x) == dims) & finite, F.lit(False))).select(F.col(f"`{key}`").alias("vec_id"), whole.alias("v"))


def first_of(kept: DataFrame, k: int, prefix: str) -> np.ndarray:
    """The ``k`` vectors whose hashed ids come first."""
    text: Column = F.concat(F.lit(prefix), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = kept.orderBy(F.sha2(text.cast("binary"), 256), "vec_id", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def _batches(batches: Iterator[pa.RecordBatch], dims: int, nodes: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    rows = max(1, QUEUE_BYTES // (8 * max(nodes, dims)))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, part.column("v").flatten().to_numpy().astype(np.int64).reshape(-1, dims)


def cluster(df: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, prefix: str = "3:",
            vector: str = "embedding", key: str = "vec_id") -> Clusters:
    """Lloyd's rounds on the vectors of ``df`` with ``dims`` components, none null or not finite; others are left out.

    Centroids start as the ``k`` vectors with the least sha256 of ``prefix`` and id (a null id is empty text; equal
    ids go by their components); fewer vectors make fewer centroids. Ties go to the smaller number, a centroid
    without vectors stays. Repeated rows and ids count one by one. An empty table, or one without a usable
    vector, gives no rows and no centroids. Only the id and the vector are read, so other columns may have any name.
    A component that times ``scale`` reaches 2^27 is an error, as its distances would not fit a long. Rounds end
    early once no centroid moves, since every later round would be the same.
    """
    spark = df.sparkSession
    kept = stored(vectors(df, dims, scale, vector, key), "vectors")
    centroids = first_of(kept, k, prefix).reshape(-1, dims)

    def sums(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            points, nodes = shared.value
            total, count = np.zeros(points.shape, np.int64), np.zeros(len(points), np.int64)
            for _, rows in _batches(batches, dims, len(nodes)):
                label, _ = nearest(nodes, points, rows)
                order = np.argsort(label, kind="stable")
                found, first, n = np.unique(label[order], return_index=True, return_counts=True)
                total[found] += np.add.reduceat(rows[order], first)
                count[found] += n
            held = np.flatnonzero(count)
            if len(held):
                part = np.concatenate([total[held], count[held, None]], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(held, dims + 1).astype(np.int32)), pa.array(np.tile(np.arange(dims + 1, dtype=np.int32), len(held))),
                                                  pa.array(part.reshape(-1))], names=["cluster", "place", "total"])
        return run

    for _ in range(rounds if len(centroids) else 0):
        shared = spark.sparkContext.broadcast((centroids, vantage_tree(centroids)))
        part = kept.select("v").mapInArrow(sums(shared), "cluster int, place int, total long")
        whole = part.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
        shared.unpersist()
        total = {(r["cluster"], r["place"]): int(r["total"]) for r in whole}
        moved = np.array([[total[c, i] // total[c, dims] for i in range(dims)] if (c, dims) in total else centroids[c] for c in range(len(centroids))], np.int64)
        if np.array_equal(moved, centroids):
            break
        centroids = moved
    shared = spark.sparkContext.broadcast((centroids, vantage_tree(centroids)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, nodes = shared.value
        for batch, rows in _batches(batches, dims, len(nodes)):
            label, distance = nearest(nodes, points, rows)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(label.astype(np.int32)), pa.array(distance)],
                                             names=["vec_id", "cluster", "distance"])

    schema = kept.select("vec_id").schema.add("cluster", T.IntegerType()).add("distance", T.LongType())
    assigned = stored(kept.mapInArrow(assign, schema), "clusters")
    found = {r["cluster"]: int(r["inertia"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    return Clusters(assigned, [tuple(c) for c in centroids.tolist()], [found.get(c, 0) for c in range(len(centroids))])
