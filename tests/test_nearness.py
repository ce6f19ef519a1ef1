"""Close values beside brute force: edit distance by segments, token overlap by MinHash; lineage within a row."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from rowmill.operators import nearness as N
from rowmill.operators import overlap as O
from rowmill.operators.jobs import lineage, parse_jobs
from rowmill.operators.lookup import fuzzy_lookup, similar_pairs


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def edited(word, edits, rng, letters):
    for _ in range(edits):
        at = rng.randrange(len(word) + 1)
        word = rng.choice([word[:at] + rng.choice(letters) + word[at:], word[:at] + word[at + 1:], word[:at] + rng.choice(letters) + word[at + 1:]])
    return word


def words(seed, n, least, most, letters):
    rng = random.Random(seed)
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(least, most))) for _ in range(n)]
    return made, [edited(rng.choice(made), rng.randint(0, 4), rng, letters) for _ in range(n)] + ["", letters[0]]


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values] + [(None,)], "w string")


@pytest.mark.parametrize("limit,least,most,letters", [(0, 0, 6, "ab"), (1, 0, 9, "ab"), (2, 3, 14, "abcé"), (3, 0, 9, "ab"), (3, 40, 44, "abcdefgh")])
def test_close_pairs_beside_all_pairs(spark, limit, least, most, letters):
    """Also with every key made finer, as if all were crowded."""
    right, left = words(limit * 100 + most, 40, least, most, letters)
    want = {(a, b, d) for a in set(left) for b in set(right) if (d := distance(a, b)) <= limit}
    assert len(want) > 10 or limit == 0
    for crowd, rounds in ((1000, 2), (0, 3)):
        got = N.close_pairs(frame(spark, left), frame(spark, right), "w", "w", limit, crowd, rounds).collect()
        assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("limit", [1, 2, 3])
def test_texts_of_200_characters(spark, limit):
    rng = random.Random(limit)
    right = ["".join(rng.choice("abcd efgh") for _ in range(200)) for _ in range(40)]
    left = [edited(rng.choice(right), rng.randint(0, 4), rng, "abcd") for _ in range(40)]
    a, b = frame(spark, left).distinct(), frame(spark, right).distinct()
    want = a.toDF("x").crossJoin(b.toDF("y")).withColumn("d", F.levenshtein("x", "y")).filter(f"d <= {limit}").select("x", "y", "d")
    assert rows(N.close_pairs(a, b, "w", "w", limit)) == rows(want) != []


def test_long_texts_have_few_keys(spark):
    texts = frame(spark, ["x" * 50 + "y" * 150, "z" * 1000]).filter("w IS NOT NULL").withColumnRenamed("w", "text")
    for limit in (1, 2, 3):
        sizes = texts.select(F.size(F.expr(N.index_keys(limit))), F.size(F.expr(N.probe_keys(limit)))).collect()
        assert {r[0] for r in sizes} == {limit + 1}
        assert len({r[1] for r in sizes}) == 1 and sizes[0][1] <= (2 * limit + 1) * (limit + 1) * (limit + 1)


def test_a_crowded_segment_does_not_pair_all_its_values(spark):
    """A third of all keys is one segment; what is compared stays near what is close."""
    values = [f"Customers of the region {(i * 7919) % 100003:06d}-{(i * 104729) % 99991:06d}" for i in range(200)]
    df = frame(spark, values)
    index = N.values_of(df, "w").selectExpr("id", "0L AS above", "value AS text")
    every = N._candidates(index, index, 1, 1000, 1).distinct().count()
    fine = N._candidates(index, index, 1, 10, 3).distinct().count()
    assert every == 200 * 200 and fine < every / 10
    got = {(r[0], r[1]) for r in N.close_pairs(df, df, "w", "w", 1, crowd=10).collect()}
    assert got == {(a, b) for a in values for b in values if distance(a, b) <= 1}


@pytest.mark.parametrize("threshold,recall", [(0.3, 0.9), (0.6, 0.97), (0.8, 0.99), (1.0, 0.9)])
def test_bands_reach_the_recall(threshold, recall):
    bands, length = N.bands_for(threshold, recall)
    assert bands * length <= N.HASHES and 1 - (1 - threshold ** length) ** bands >= recall
    with pytest.raises(ValueError):
        N.bands_for(0.01, 0.999, 4)


@pytest.mark.parametrize("threshold", [0.6, 0.8])
def test_minhash_recall_and_exactness(spark, threshold):
    urls = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("url")
    exact = {(r[0], r[1]): r[2] for r in similar_pairs(urls, urls, "url", "url", threshold, ngram=3).collect()}
    found = {(r[0], r[1]): r[2] for r in similar_pairs(urls, urls, "url", "url", threshold, ngram=3, recall=0.97).collect()}
    assert found.items() <= exact.items()
    different = {p for p in exact if p[0] != p[1]}
    assert len(different) > 50 and len(different & found.keys()) >= 0.9 * len(different)


def test_minhash_with_equal_sets_and_no_words(spark):
    df = frame(spark, ["a b c", "c b a", "a b c d", "", "  ", "x"])
    got = {(r[0], r[1]) for r in similar_pairs(df, df, "w", "w", 1.0, recall=0.99).collect()}
    assert got == {(a, b) for a in ("a b c", "c b a") for b in ("a b c", "c b a")} | {("a b c d",) * 2, ("x",) * 2}
    near = fuzzy_lookup(df, df.withColumnRenamed("w", "m"), "w", "m", ["m"], jaccard=0.7, recall=0.99)
    assert ("a b c d", "a b c") not in rows(near) and near.count() == df.count()


XML = '<Job><node componentName="x"/>{}</Job>'


def plain_lineage(links):
    out = {}
    for source in {a for a, _ in links}:
        newest, d = {source}, 0
        reached = {}
        while newest:
            d += 1
            newest = {b for a, b in links if a in newest} - reached.keys()
            reached.update({b: d for b in newest})
        out.update({(source, t): n for t, n in reached.items()})
    return out


@pytest.mark.parametrize("links", [[], [("a", "b")], [("a", "a")], [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("a", "c")],
                                   [(str(i), str(i + 1)) for i in range(30)] + [("5", "20"), ("30", "3")]])
def test_lineage_beside_plain_python(spark, links):
    xml = XML.format("".join(f'<connection connectorName="FLOW" label="l" source="{a}" target="{b}"/>' for a, b in links))
    jobs = parse_jobs(spark.createDataFrame([("j", xml), ("k", XML.format("")), ("bad", "no xml")], "job string, xml string"))
    got = lineage(jobs)
    assert {(r.source, r.target): r.distance for r in got.collect()} == plain_lineage(links)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def sent_whole(df):
    """Joins of an executed plan whose one side the driver sent to all tasks; keys of crowds, a thousandth of all at most, may be."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    return re.findall(r"BroadcastHashJoin.* Inner.*", plan)


def test_close_pairs_send_no_side_through_the_driver(spark):
    df = frame(spark, [f"region {i:04d}" for i in range(200)])
    assert sent_whole(N.close_pairs(df, df, "w", "w", 1)) == []


def test_pairs_that_are_not_close_end_where_they_meet(spark):
    """All values share a segment; texts too long to go along are compared later, and none is lost."""
    values = [f"Customers of the region {(i * 7919) % 100003:06d}-{(i * 104729) % 99991:06d}" for i in range(100)]
    df = frame(spark, values)
    index = N.values_of(df, "w").selectExpr("id", "0L AS above", "value AS text")
    near = sum(distance(a, b) <= 1 for a in values for b in values)
    assert N._candidates(index, index, 1, 1000, 1, check=True).distinct().count() == near == 100
    long = frame(spark, ["x" * 600, "x" * 599 + "y", "z" * 700])
    assert N.close_pairs(long, long, "w", "w", 1).count() == 5


def test_band_keys_beside_plain_ones(spark):
    """A band works out its own hashes only."""
    df = frame(spark, ["a b c", "b c d e", "x"]).filter("w IS NOT NULL").withColumn("words", F.split("w", " "))
    least = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda seed: F.array_min(F.transform("words", lambda w: F.xxhash64(w, seed))))
    want = F.array(*[F.xxhash64(F.lit(b), F.slice(least, b * 3 + 1, 3)) for b in range(4)])
    keys = N.band_keys(F.col("words"), 4, 3)
    assert df.filter(keys == want).count() == 3
    seeds = df.select(keys.alias("k"))._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(" not in seeds


@pytest.mark.parametrize("recall", [None, 0.97])
def test_token_overlap_sends_no_side_through_the_driver(spark, recall):
    df = frame(spark, [f"region {i} of {i % 7}" for i in range(200)])
    assert sent_whole(similar_pairs(df, df, "w", "w", 0.6, ngram=3, recall=recall)) == []


@pytest.mark.parametrize("carried", [0, 3, 500])
@pytest.mark.parametrize("recall", [None, 0.999])
def test_sets_too_large_to_go_along_lose_no_pair(spark, monkeypatch, carried, recall):
    monkeypatch.setattr(N, "CARRIED", carried)
    df = frame(spark, ["a b c", "a b c d", "a b", "x y", "x y z w"])
    pairs = {("a b c", "a b c d"), ("a b c", "a b")}
    want = {(v, v) for v in ("a b c", "a b c d", "a b", "x y", "x y z w")} | pairs | {p[::-1] for p in pairs}
    assert {(r[0], r[1]) for r in similar_pairs(df, df, "w", "w", 0.65, recall=recall).collect()} == want


def jaccard(a, b):
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("cell", [3, 4096])
@pytest.mark.parametrize("recall", [None, 0.999999])
def test_token_overlap_in_cells_beside_all_pairs(spark, monkeypatch, cell, recall):
    """Keys that all values share are dealt to a grid of cells; a pair comes once, from whichever of them it is."""
    monkeypatch.setattr(O, "CELL", cell)
    rng = random.Random(cell)
    left, right = ([" ".join(rng.sample("abcdefgh", rng.randint(1, 6))) for _ in range(60)] for _ in range(2))
    got = similar_pairs(frame(spark, left), frame(spark, right), "w", "w", 0.7, recall=recall).collect()
    want = {(a, b, s) for a in set(left) for b in set(right) if (s := jaccard(set(a.split()), set(b.split()))) >= 0.7}
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 50


def test_no_cell_has_many_rows_of_a_crowded_key(spark):
    rows_ = spark.range(4000).selectExpr("IF(id % 4 = 0, 'a', 'b') AS key", "id % 3 = 0 AS right", "array(id) AS values", "array('w') AS words",
                                         "CAST(array() AS array<string>) AS before")
    alone = spark.range(500).selectExpr("'c' AS key", "true AS right", "array(id) AS values", "array('w') AS words",
                                        "CAST(array() AS array<string>) AS before")
    dealt = O.deal(rows_.union(alone), 100)
    sizes = dealt.groupBy("cell", "right").count().collect()
    assert max(r["count"] for r in sizes) <= 160
    met = dealt.filter("NOT right").toDF("cell", "r", "x", "w", "b").join(dealt.filter("right").toDF("cell", "r2", "y", "w2", "b2"), "cell")
    key = rows_.selectExpr("key", "right", "values[0] AS v")
    assert met.count() == met.select("x", "y").distinct().count() == key.filter("NOT right").toDF("key", "r", "x").join(key.filter("right").toDF("key", "r2", "y"), "key").count()


def test_pairs_are_given_where_they_meet(spark):
    """No candidate is shuffled, told apart or joined with its texts afterwards."""
    df = frame(spark, ["a b c", "a b c d", "x y"])
    for recall in (None, 0.97):
        plan = similar_pairs(df, df, "w", "w", 0.6, recall=recall)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Union") < plan.index("MapInArrow") < plan.index("Aggregate")


@pytest.mark.parametrize("tile,small,dense,step", [(512, 512, 300, 1000), (2, 5, 1, 7), (3, 1, 10**9, 1), (1, 1000, 2, 3)])
def test_cells_beside_plain_ones(tile, small, dense, step):
    """Also cells that come in several batches, and values of equal sets."""
    rng = random.Random(step)
    made = []
    for cell in range(12):
        for k in range(rng.choice([0, 1, 2, 25])):
            made.append((f"c{cell:02d}", rng.random() < 0.5, [f"{cell}-{k}-{m}" for m in range(rng.choice([1, 1, 3]))],
                         rng.sample("abcdefgh", rng.randint(1, 6)), [i for i in range(9) if rng.random() < 0.15]))
    want = sorted((v, w, jaccard(set(a[3]), set(b[3]))) for a in made for b in made if a[0] == b[0] and not a[1] and b[1]
                  and jaccard(set(a[3]), set(b[3])) >= 0.5 and not set(a[4]) & set(b[4]) for v in a[2] for w in b[2])
    kinds = pa.schema([("cell", pa.string()), ("right", pa.bool_()), ("values", pa.list_(pa.string())), ("words", pa.list_(pa.string())),
                       ("before", pa.list_(pa.int64()))])
    table = pa.table([pa.array(c, f.type) for c, f in zip(zip(*made), kinds)], schema=kinds)
    compare = O.compare_cells(0.5, tile, small, dense, rows_out=4)
    batches = list(compare(iter(table.to_batches(max_chunksize=step))))
    assert sorted(tuple(r.values()) for b in batches for r in b.to_pylist()) == want and len(want) > 50
    assert max(b.num_rows for b in batches) <= 4
