"""Clusters, manifests and the quality model beside plain Python."""

import hashlib
import zlib
from collections import defaultdict
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm_fixtures import SMALL, edge, none  # noqa: F401
from rowmill.llm import centroids, manifest, quality


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- clusters


def plain_clusters(rows, k, rounds, dims):
    kept = [(i, [floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (sha("3:" + ("" if r[0] is None else str(r[0]))), r[0] is not None, r[0] or 0, r[1]))[:k]
    points = [v for _, v in first]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[near(v)[1]].append(v)
        points = [[sum(x) // len(members[c]) for x in zip(*members[c])] if members[c] else p for c, p in enumerate(points)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in kept), key=str), [tuple(p) for p in points]


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("cluster", T.StringType()), T.StructField("a.b", T.IntegerType()), T.StructField("v", T.IntegerType())])


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "clash", 1, 2) for i, v in rows], VECTORS).repartition(3)


def grid(n, dims, seed, wide=3):
    """Few different components: many equal distances, equal vectors and empty centroids."""
    rng = np.random.default_rng(seed)
    return [(i, [float(x) / 8 for x in rng.integers(-wide, wide + 1, dims)]) for i in range(n)]


@pytest.mark.parametrize("rows,k,dims", [
    (grid(120, 3, 1), 8, 3), (grid(90, 2, 2, 1), 17, 2), (grid(5, 4, 3), 8, 4), (grid(1, 4, 3), 3, 4),
    ([(i, [0.5, 0.5]) for i in range(60)] + [(60 + i, [i / 7, -i / 9]) for i in range(9)], 12, 2),
    ([(None, [1.0, 2.0]), (None, [1.0, 2.0]), (3, None), (4, [1.0]), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]),
      (8, [-0.0001, 0.0]), (8, [-0.0001, 0.0]), (9, [5.0, 5.0])], 2, 2)])
def test_clusters_beside_plain_python(spark, rows, k, dims):
    got = centroids.cluster(vectors(spark, rows), k=k, rounds=4, dims=dims)
    exact = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want, points = plain_clusters(exact, k, 4, dims)
    assert sorted((tuple(r) for r in got.assigned.collect()), key=str) == want
    assert got.centroids == points
    assert got.inertia == [sum(d for _, c, d in want if c == n) for n in range(len(points))]


def test_no_vectors_no_clusters(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        got = centroids.cluster(vectors(spark, rows), dims=2)
        assert (got.assigned.count(), got.centroids, got.inertia) == (0, [], [])
        assert got.assigned.columns == ["vec_id", "cluster", "distance"]


def test_a_component_too_large_is_an_error(spark):
    with pytest.raises(Exception, match="would not fit"):
        centroids.cluster(vectors(spark, [(1, [1e30, 0.0])]), dims=2)


@pytest.mark.parametrize("k", [1, 2, 3, 7, 50, 300])
def test_tree_finds_the_nearest_and_the_smaller_number(k):
    rng = np.random.default_rng(k)
    for wide in (2, 40, 1 << 26):
        points, rows = rng.integers(-wide, wide + 1, (k, 5)), rng.integers(-wide, wide + 1, (400, 5))
        label, best = centroids.nearest(centroids.vantage_tree(points), points, rows)
        away = ((rows[:, None] - points) ** 2).sum(2)
        assert (best == away.min(1)).all() and (label == away.argmin(1)).all()


def test_tree_prunes():
    rng = np.random.default_rng(0)
    points = rng.integers(-1000, 1000, (256, 2))
    measured, plain = 0, centroids.squared

    def counted(vectors, point):
        nonlocal measured
        measured += len(vectors)
        return plain(vectors, point)

    rows, tree = rng.integers(-1000, 1000, (500, 2)), centroids.vantage_tree(points)
    centroids.squared = counted
    try:
        centroids.nearest(tree, points, rows)
    finally:
        centroids.squared = plain
    assert measured < 500 * 256 / 4


# --- manifest


def plain_manifest(rows, fields, fanout, later):
    def leaf(row):
        return sha("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in fields))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i:i + fanout])) for i in range(0, len(out[-1]), fanout)])
        return out

    def path(tree, at):
        out = []
        for level in tree[:-1]:
            first = at - at % fanout
            out.append(("".join(level[first:at]), "".join(level[at + 1:first + fanout])))
            at //= fanout
        return out

    groups = defaultdict(list)
    for row in rows:
        groups[row["lang"]].append((row["doc_id"], leaf(row), leaf({**row, **later(row)})))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = {g: levels([r[1] for r in groups[g]]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for number, g in enumerate(order):
        for at, (doc, own, found) in enumerate(groups[g]):
            whole = path(trees[g], at) + path(top, number)
            node = found
            for before, after in whole:
                node = sha(before + node + after)
            out.append((doc, own, trees[g][-1][0], top[-1][0], sha("".join(b + a for b, a in whole)), node, node == top[-1][0]))
    return sorted(out, key=str)


ROWS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("group", T.StringType()),
                     T.StructField("hash", T.StringType()), T.StructField("a.b", T.StringType()), T.StructField("pos", T.IntegerType())])
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def hit(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0


def changed():
    return {"n_chars": F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}


def later(row):
    return {"n_chars": row["n_chars"] + 1} if hit(row["doc_id"]) and row["n_chars"] is not None else {}


MIXED = {"en": 70, "de": 16, "fr": 17, None: 3, "": 1, "é": 5, "z": 33}


@pytest.mark.parametrize("sizes,fanout", [({"en": 1}, 2), ({"en": 2, None: 1}, 2), (MIXED, 2), ({"one": 300}, 2), (MIXED, 3), (MIXED, 5), ({"one": 300}, 17)])
def test_manifest_beside_plain_python(spark, sizes, fanout):
    rows = [(n * 1000 + i, f"text ü {i}" if i % 5 else None, lang, "s" if i % 3 else None, i if i % 4 else None, "g", "h", "x", 1)
            for n, (lang, size) in enumerate(sizes.items()) for i in range(size)]
    rows += [rows[-1], (None, "", sizes and next(iter(sizes)), None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)] * 2
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    got = manifest.manifest(df, fanout=fanout, changed=changed(), sent=0 if fanout == 3 else 1000)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=str) == plain_manifest(
        [dict(zip(ROWS.names, r)) for r in rows], manifest.FIELDS, fanout, later)


def test_manifest_of_strange_texts_and_of_nothing(spark, edge, none):
    for df in (edge, none):
        df = df.withColumn("source", F.col("host")).withColumn("n_chars", F.col("n_lines"))
        got = manifest.manifest(df, changed=changed())
        rows = [r.asDict() for r in df.collect()]
        assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=str) == plain_manifest(rows, manifest.FIELDS, 2, later)


def test_unchanged_rows_verify_and_changed_ones_do_not(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert manifest.manifest(docs).filter("not verified").count() == 0
    seen = {r.doc_id: r.verified for r in manifest.manifest(docs, changed=changed()).collect()}
    assert seen == {doc: not hit(doc) for doc in seen}


# --- quality


def test_figures_of_a_text():
    named = dict(zip(quality.FEATURES, quality.figures(b"Ab AB!! a# a#\n\nxy 12 12")))
    assert named["words"] == pytest.approx(np.log1p(7)) and named["own_words"] == pytest.approx(5 / 7)
    assert named["digits"] == pytest.approx(4 / 23) and named["repeats"] == pytest.approx(2 / 7)
    assert named["shouted"] == pytest.approx(1 / 7) and named["ended"] == pytest.approx(3 / 7)
    assert named["worst_line"] == pytest.approx(3 / 4) and named["own_lines"] == 1
    assert quality.figures(b"") == [0.0] * len(quality.FEATURES)


def test_trees_take_the_best_cuts():
    g = np.array([-4.0, -4, 5, 5, 5, -1])
    w = np.ones(6)
    out = quality.shallow_tree(g, w, leaves=3)
    assert out == pytest.approx([-8 / 3, -8 / 3, 15 / 4, 15 / 4, 15 / 4, -1 / 2])
    gain, out = quality.pair_tree(np.array([[3.0, -3], [-3, 3]]), np.ones((2, 2)))
    assert out == pytest.approx(np.array([[1.5, -1.5], [-1.5, 1.5]])) and gain == pytest.approx(18)


def test_model_learns_a_curve_and_an_interaction():
    rng = np.random.default_rng(1)
    values = rng.random((6000, 3)).astype(np.float32)
    label = (((values[:, 0] > 0.5) ^ (values[:, 1] > 0.5)) | (np.abs(values[:, 2] - 0.5) < 0.05)).astype(int)
    edges = [np.quantile(values[:, i], np.arange(1, 32) / 32).astype(np.float32) for i in range(3)]
    model = quality.fit(values[:4000], label[:4000], edges)
    assert (0, 1) in model.pairs
    assert ((model.scores(values[4000:]) > 0.5) == label[4000:]).mean() > 0.93
    assert ((quality.fit(values[:4000], label[:4000], edges, pairs=0).scores(values[4000:]) > 0.5) == label[4000:]).mean() < 0.75


def test_scores_are_sums_of_table_entries(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.described(docs)
    model = quality.train(rows, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, labels).collect()}
    for row in docs.collect():
        values = np.float32(quality.figures((row.text or "").encode()))
        bins = [sum(float(v) >= float(e) for e in edges) for v, edges in zip(values, model.edges)]
        total = model.offset + sum(t[b] for t, b in zip(model.tables, bins))
        total += sum(t[model.coarse[i][bins[i]], model.coarse[j][bins[j]]] for (i, j), t in zip(model.pairs, model.pair_tables))
        assert got[row.doc_id] == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-9)


def test_quality_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.score(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())
    seen = [(got[r.doc_id].score >= 0.3, r.quality) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    assert len(seen) > 50 and sum(p == bool(q) for p, q in seen) / len(seen) >= 0.97


def test_held_out_labels_teach_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = ({r.doc_id: r.score for r in quality.score(docs, x).collect()} for x in (labels, turned))
    assert first == second


@pytest.mark.parametrize("label", [None, 0, 1])
def test_quality_without_two_labels(spark, edge, none, label):
    schema = "doc_id long, quality int"
    labels = spark.createDataFrame([] if label is None else [(3, label), (4, None), (None, 1), (3, label)], schema)
    scores = {r.score for r in quality.score(edge, labels).collect()}
    assert len(scores) == 1 and quality.score(edge, labels).count() == edge.count()
    assert {None: 0.5}.get(label) in (None, scores.pop())
    empty = quality.score(none, labels)
    assert empty.count() == 0 and empty.columns == ["doc_id", "held_out", "score", "reasons"]


def test_sample_is_bounded(spark, edge):
    ids = [r.doc_id for r in edge.select("doc_id").distinct().collect() if r.doc_id is not None]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    model = quality.train(quality.described(edge), labels, sample_rows=4)
    assert isinstance(model.offset, float)
    assert {r.score for r in quality.score(edge, labels, sample_rows=1).collect()}
