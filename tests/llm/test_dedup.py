"""Line and near-duplicate removal beside brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from llm_fixtures import documents, edge, none  # noqa: F401
from rowmill.llm import line_dedup, simhash
from rowmill.llm.line_dedup import CuckooFilter, LineIndex, dedup_lines

SPACES = " \t\n\x0b\f\r"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_lines(rows, min_docs=5):
    held = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = low(line.strip(SPACES))
            if len(key) >= 40:
                held.setdefault(key, set()).add(-1 if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        own = -1 if doc is None else doc
        gone = [len(held.get(low(x.strip(SPACES)), ())) >= min_docs and max(held[low(x.strip(SPACES))]) > own for x in lines]
        out.append((own, "\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone)))
    return sorted(out)


def cleaned(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in df.collect())


@pytest.mark.parametrize("name", ["edge", "documents", "none"])
def test_lines(name, request):
    df = request.getfixturevalue(name)
    out = dedup_lines(df)
    assert cleaned(out) == plain_lines([(r.doc_id, r.text) for r in df.collect()])
    assert set(out.columns) == set(df.columns) | {"n_lines", "n_dropped"}


def test_lines_without_filters_in_memory(edge, spark):
    index = LineIndex(spark, filter_bytes=0).insert(edge)
    assert cleaned(index.clean(edge)) == plain_lines([(r.doc_id, r.text) for r in edge.collect()])


def test_index_is_reversible(documents, spark):
    """Insert in parts, delete some: the same as an index of what is left."""
    a, b = documents.filter("doc_id % 3 = 0"), documents.filter("doc_id % 3 > 0")
    gone = documents.filter("doc_id % 5 = 1")
    left = documents.filter("doc_id % 5 != 1")
    index = LineIndex(spark, min_docs=2, shard_keys=64).insert(a).insert(b).delete(gone.select("doc_id"))
    fresh = LineIndex(spark, min_docs=2).insert(left)
    assert sorted(map(tuple, index.common.collect())) == sorted(map(tuple, fresh.common.collect()))
    want = plain_lines([(r.doc_id, r.text) for r in left.collect()], min_docs=2)
    assert cleaned(index.clean(left)) == want == cleaned(fresh.clean(left, indexed=True))


def test_cuckoo_filter():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 2 ** 63, 20_000).astype(np.uint64)
    made = line_dedup.build_filter(hashes)
    assert made.holds(hashes).all()
    made.delete(hashes[:10_000])
    assert made.holds(hashes[10_000:]).all() and made.holds(hashes[:10_000]).mean() < 0.01
    again = CuckooFilter.from_bytes(made.to_bytes())
    assert again.insert(hashes[:10_000]) and again.holds(hashes).all()


def plain_fingerprint(text, n=3):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low(text or "")) if w]
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marks):
    root = list(range(len(marks)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(marks))]


@pytest.mark.parametrize("name", ["edge", "documents", "none"])
@pytest.mark.parametrize("pair_limit", [1, 24])
def test_simhash(name, pair_limit, request):
    rows = [(r.doc_id, r.text) for r in request.getfixturevalue(name).collect()]
    marks = [plain_fingerprint(t) for _, t in rows]
    groups = {}
    for (doc, _), c in zip(rows, plain_components(marks)):
        groups.setdefault(c, []).append(-1 if doc is None else doc)
    want = sorted((-1 if d is None else d, f"{m:016x}", min(groups[c])) for (d, _), m, c in zip(rows, marks, plain_components(marks)))
    got = simhash.near_duplicates(request.getfixturevalue(name), pair_limit=pair_limit).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.fingerprint, -1 if r.component_id is None else r.component_id) for r in got) == want


@pytest.mark.parametrize("distance", [0, 1])
def test_smaller_distances(documents, distance):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in documents.collect()]
    for limit in (1, 24):
        got = {r.doc_id: r.component_id for r in simhash.near_duplicates(documents, max_distance=distance, pair_limit=limit).collect()}
        for a, x in rows:
            assert all(got[a] == got[b] for b, y in rows if (x ^ y).bit_count() <= distance)


def test_keys_meet_within_two_bits():
    random.seed(5)
    marks = [random.getrandbits(64) for _ in range(300)]
    for m in marks:
        a, b = random.sample(range(64), 2)
        pair = np.array([m, m ^ (1 << a) ^ (1 << b)], np.uint64)
        rows, keys = simhash.golay_keys(pair)
        assert set(keys[rows == 0]) & set(keys[rows == 1])
        assert (rows == 0).sum() <= 18


def test_keep_one(edge, documents):
    for df in (edge, documents):
        kept = simhash.keep_one(df)
        groups = simhash.grouped(df, 3, 2, 42, 24)
        assert kept.columns == df.columns
        assert kept.count() == groups.select("root").distinct().count()


def test_long_texts_are_read_in_blocks(monkeypatch):
    text = b" ".join(b"w%d" % (i % 97) for i in range(5000)) + b"  \n tail " + b"y" * 300
    want = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 64)
    assert simhash.fingerprint(text) == want == plain_fingerprint(text.decode())
    assert simhash.fingerprint(b"a b") == plain_fingerprint("a b")
