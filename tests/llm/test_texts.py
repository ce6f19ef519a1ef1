"""Pseudonyms, suffix removal, toxicity, URLs and decontamination beside plain versions."""

import hashlib
import re
import zlib
from datetime import date, timedelta
from ipaddress import ip_address

import numpy as np
import pytest

from llm_fixtures import SMALL, documents, edge, none  # noqa: F401
from rowmill.llm import decontam, suffix_dedup, toxicity, urls
from rowmill.llm.pseudonyms import ROUNDS, pseudonymize

KEY = "k"


def turn(x, y, m, n, kind):
    for i in range(ROUNDS):
        by = int(hashlib.sha256(f"{KEY}|{kind}|{i}|{m}|{n}|{y}".encode()).hexdigest()[:14], 16)
        x, y, m, n = y, (x + by) % m, n, m
    return x, y


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total


def like(value, digits):
    it = iter(digits)
    return re.sub("[0-9]", lambda _: next(it), value)


def plain_card(value):
    d = re.sub("[^0-9]", "", value)
    a = (len(d) - 2) // 2
    b = len(d) - 2 - a
    x, y = turn(int(d[1:1 + a]), int(d[1 + a:-1]), 10 ** a, 10 ** b, "card")
    body = f"{d[0]}{x:0{a}d}{y:0{b}d}"
    return like(value, body + str(-luhn(body + "0") % 10)) if luhn(d) % 10 == 0 and int(d) else value


def plain_phone(value):
    d = re.sub("[^0-9]", "", value)
    lead, t = d[:-10], d[-10:]
    x, y = turn(int(t[1:3] + t[4:6]), int(t[6:]), 10_000, 10_000, "phone")
    return like(value, f"{lead}{t[0]}{x:04d}"[:len(lead) + 3] + t[3] + f"{x:04d}"[2:] + f"{y:04d}")


def plain_iso(value):
    try:
        day = date.fromisoformat(value)
    except ValueError:
        return value
    first = date(day.year // 100 * 100, 1, 1)
    a, b = (75, 487) if first.year % 400 == 0 else (92, 397)
    place = (day - first).days
    x, y = turn(place // b, place % b, a, b, "date")
    return (first + timedelta(x * b + y)).isoformat()


def plain_address(value):
    try:
        ip_address(value)
    except ValueError:
        return value
    o = value.split(".")
    low, size = [(0, 10, 100)[len(v) - 1] for v in o], [(10, 90, 156)[len(v) - 1] for v in o]
    p = [int(v) - w for v, w in zip(o, low)]
    x, y = turn(p[0] * size[1] + p[1], p[2] * size[3] + p[3], size[0] * size[1], size[2] * size[3], "address")
    return ".".join(str(v + w) for v, w in zip((x // size[1], x % size[1], y // size[3], y % size[3]), low))


def changed(spark, values):
    rows = pseudonymize(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, text string"), KEY).collect()
    return [r.text for r in sorted(rows)]


def test_pseudonyms_beside_plain_versions(spark):
    rng = np.random.default_rng(2)
    cards = ["4041894974608795", "4041 8949 7460 8795", "4041894974608796", "378282246310005", "3782-822463-10005", "0000000000000000"]
    phones = ["(386) 555-3733", "386-555-3733", "1-386-555-3733", "212.555.0000"]
    dates = [f"{y:04d}-{m:02d}-{d:02d}" for y, m, d in zip(rng.integers(1000, 2400, 300), rng.integers(0, 14, 300), rng.integers(0, 33, 300))]
    dates += ["2000-02-29", "1900-02-29", "1999-12-31"]
    hosts = [".".join(map(str, v)) for v in rng.integers(0, 290, (200, 4))] + ["01.2.3.4", "0.0.0.0", "255.255.255.255"]
    for values, plain in ((cards, plain_card), (phones, plain_phone), (dates, plain_iso), (hosts, plain_address)):
        assert changed(spark, values) == [plain(v) for v in values]


def test_pseudonyms_are_permutations(spark):
    first = date(1900, 1, 1)
    days = [(first + timedelta(i)).isoformat() for i in range(36_524)]
    new = changed(spark, [" ".join(days)])[0].split()
    assert sorted(new) == days and new != days
    ssns = [f"{a:03d}-{g:02d}-{s:04d}" for a in (1, 665, 666, 667, 899, 900) for g in (1, 99) for s in (1, 9999)]
    got = dict(zip(ssns, changed(spark, [" ".join(ssns)])[0].split()))
    assert all((k == v) == (k[:3] in ("666", "900")) for k, v in got.items()) and len(set(got.values())) == len(got)
    mails = [f"{a}{b}.{n}@mail1.example.com" for a in "abcdefghijklm" for b in "NOPQRSTUVWXYZ" for n in range(10)]
    new = changed(spark, [" ".join(mails)])[0].split()
    assert len(set(new)) == len(mails) and all(re.fullmatch(r"[a-z][A-Z]\.\d@mail1\.example\.com", m) for m in new)


def test_equal_values_stay_linked_and_the_rest_stays(spark, edge, none):
    text = "Call (386) 555-3733, pay 4041894974608795 on 2024-02-29 from 61.131.143.218 as bosbt.42@mail8.example.com."
    a, b, c = changed(spark, [text, f"x\n{text} {text}", "12345678901234567890 1.2.3 1.2.3.4.5 2023-13-01 a@b"])
    assert b == f"x\n{a} {a}" and a != text and len(a) == len(text)
    assert c == "12345678901234567890 1.2.3 1.2.3.4.5 2023-13-01 a@b"
    out = pseudonymize(edge, KEY)
    assert sorted(map(str, (r.text for r in out.collect()))) == sorted(map(str, (r.text for r in edge.collect())))
    assert out.columns == [*edge.columns, "n_values"] and pseudonymize(none, KEY).count() == 0


def plain_removal(rows):
    """(n_bytes, n_removed, n_spans, kept) of each row, by all strings of 50 bytes."""
    least = {}
    for doc, text in rows:
        for p in range(len(text) - 49):
            s = text[p:p + 50]
            least[s] = min(least.get(s, doc), doc)
    for doc, text in rows:
        gone = np.zeros(len(text) + 1, bool)
        for p in range(len(text) - 49):
            if least[text[p:p + 50]] < doc:
                gone[p:p + 50] = True
        gone = gone[:len(text)]
        yield (len(text), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), np.frombuffer(text, np.uint8)[~gone].tobytes())


@pytest.mark.parametrize("options", [{}, {"hot_bytes": 100, "shard_bytes": 2000, "count_bytes": 1000, "sent_hot": 0, "sent_copies": 0}], ids=["plain", "split"])
@pytest.mark.parametrize("name", ["edge", "documents", "none"])
def test_suffix_removal(name, options, request):
    df = request.getfixturevalue(name)
    rows = [(-1 if r.doc_id is None else r.doc_id, (r.text or "").encode()) for r in df.collect()]
    got = [(-1 if r.doc_id is None else r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))) for r in suffix_dedup.remove_repeats(df, **options).collect()]
    assert sorted(got) == sorted((d, x) for (d, _), x in zip(rows, plain_removal(rows)))


def test_suffix_array():
    rng = np.random.default_rng(0)
    for n in (*range(1, 30), 300, 301, 302):
        for k in (1, 2, 4):
            s = rng.integers(1, k + 1, n)
            assert suffix_dedup.suffix_array(s).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())


def test_long_texts_are_cut_with_overlap(monkeypatch):
    text = bytes(np.random.default_rng(1).integers(97, 101, 3000).astype(np.uint8))
    whole = {(p + j, x) for _, place, n, least, _, _ in suffix_dedup.runs([text]) for p, k, x in zip(place, n, least) for j in range(k)}
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 100)
    assert {(p + j, x) for _, place, n, least, _, _ in suffix_dedup.runs([text]) for p, k, x in zip(place, n, least) for j in range(k)} == whole
    assert {p for p, _ in whole} == set(range(3000 - 49))


def plain_segments(scores):
    """The maximal segments: best first, then the same left and right of it."""
    best = max(((sum(scores[i:j]), -(j - i), i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0,))
    if best[0] <= 1e-9:
        return []
    _, _, i, j = best
    return plain_segments(scores[:i]) + [(i, j, best[0])] + [(a + j, b + j, s) for a, b, s in plain_segments(scores[j:])]


def test_maximal_segments():
    rng = np.random.default_rng(4)
    for _ in range(200):
        up = rng.random(25) < 0.4
        scores = np.where(up, rng.random(25) * 3 + 0.01, -0.7).tolist()
        places = np.flatnonzero(up).tolist()
        got = toxicity.maximal_segments(places, [scores[p] for p in places], 0.7)
        want = plain_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


@pytest.fixture(scope="module")
def labelled(spark):
    folder = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_repeated_scoring_words_cost_nothing(spark):
    assert toxicity.maximal_segments([3, 4, 5, 6], [2.0, 0.0, 0.0, 1.0]) == [(3, 7, 3.0)]
    assert toxicity.maximal_segments([3, 4], [2.0, 0.0]) == [(3, 4, 2.0)] and toxicity.maximal_segments([0, 1], [0.0, 0.0]) == []
    plain = "some plain words that nobody minds at all"
    learned = [(i, f"{plain} {'vile foul ' if i % 4 == 0 else ''}{plain}", int(i % 4 == 0)) for i in range(400)]
    asked = [(1000, f"{plain} vile foul {plain}"), (1001, f"{plain} vile vile vile vile foul {plain}")]
    docs = spark.createDataFrame([r[:2] for r in learned] + asked, "doc_id long, text string")
    labels = spark.createDataFrame([r[::2] for r in learned], "doc_id long, toxic int")
    for sent in (toxicity.SENT_WORDS, 0):
        made = toxicity.score(docs, labels, sent_words=sent, sent_labels=sent).collect()
        once, often = ([(p.start, p.end, p.score) for p in r.passages] for r in sorted(made, key=lambda r: r.doc_id) if r.doc_id >= 1000)
        assert [(8, 10)] == [p[:2] for p in once] and [(8, 13)] == [p[:2] for p in often] and abs(once[0][2] - often[0][2]) < 1e-9


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    rows = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    assert len(rows) == docs.count()
    truth = [(rows[r.doc_id].score, r.toxic) for r in labels.collect() if r.doc_id % 1 == 0 and rows[r.doc_id].held_out]
    hits = sum(s >= 0.7 for s, t in truth if t)
    assert hits >= 0.85 * sum(t for _, t in truth) and sum(s >= 0.7 for s, t in truth if not t) <= 0.02 * len(truth)
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in rows)


def test_passages_have_no_floor_before_the_bar(labelled):
    made = [r for r in toxicity.score(*labelled).collect() if r.passages]
    assert any(0 < p.score < 1 for r in made for p in r.passages)


def test_toxicity_by_joins_is_the_same(labelled):
    docs, labels = labelled
    a = {r.doc_id: r.score for r in toxicity.score(docs, labels).collect()}
    b = {r.doc_id: r.score for r in toxicity.score(docs, labels, sent_words=0, sent_labels=0).collect()}
    assert a.keys() == b.keys() and all(abs(a[i] - b[i]) < 1e-6 for i in a)


def test_toxicity_ignores_held_out_labels(labelled):
    docs, labels = labelled
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(labels.doc_id), 1 - labels.toxic).otherwise(labels.toxic))
    a = sorted((r.doc_id, round(r.score, 9)) for r in toxicity.score(docs, labels).collect())
    assert a == sorted((r.doc_id, round(r.score, 9)) for r in toxicity.score(docs, flipped).collect())


def test_toxicity_edges(spark, edge, none):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(3, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    scored = toxicity.score(edge, labels).collect()
    assert len(scored) == edge.count() and all(0 <= r.score <= 1 for r in scored)
    assert {r.score for r in toxicity.score(edge, labels.limit(0)).collect()} == {0.5}
    assert toxicity.score(none, labels).count() == 0
    kept = toxicity.keep_clean(edge, labels)
    assert kept.columns == edge.columns and kept.count() <= edge.count()


def test_urls(spark):
    rows = ["http://a.org/x?y#z", "HTTP://Sub.Example.ORG/es/1", "http://example.org/en/12", "http://example.org/en/2", "http://b.com/fr/", "http://b.com/de/x",
            "http://badexample.org/es/", "http://casino-win.example.net/", "http://casinos.net/", "x://free.net/pills?q", "http://free.net/", "no scheme casino",
            "", None, "http://org", "http://win.net/free#cheap://x", "a\nb://c\nd/e"]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(rows)], "page_id long, url string, host string")
    rules = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
    got = {r.page_id: r for r in urls.judge(df, rules).collect()}
    for i, url in enumerate(rows):
        host = path = ""
        if url and "://" in url:
            host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        low = (url or "").lower()
        strict = sum(bool(re.search(rf"(?<![a-z0-9]){t}(?![a-z0-9])", low)) for t in urls.STRICT)
        soft = sum(bool(re.search(rf"(?<![a-z0-9]){t}(?![a-z0-9])", low)) for t in urls.SOFT)
        host = host.lower()
        fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        verdict = max(fits)[2] if fits else "block" if strict or soft >= 2 else "allow"
        r = got[i]
        assert (r.host, r.path, r.rule, r.verdict, r.n_strict, r.n_soft) == (host, path, max(fits)[1] if fits else None, verdict, strict, soft), url


def plain_leaks(docs, items):
    """Best verified score of each pair, scoring every passage against every item."""
    n, words = len(items), [decontam.terms_of(t) for _, t in items]
    frequency = {}
    for w in words:
        for t in set(w):
            frequency[t] = frequency.get(t, 0) + 1
    index = decontam.Index(items, frequency, n, sum(map(len, words)) / max(1, n))
    weights = {}
    for term, number in index.vocab.items():
        for item, weight in zip(*index.lists[number][:2]):
            weights.setdefault(item, {})[term] = weight
    out = {}
    for doc, text in docs:
        own = decontam.terms_of(text)
        for lo in range(0, len(own), index.stride):
            part = own[lo:lo + index.window]
            held = decontam.shingles(part)
            for item, w in weights.items():
                score = sum(w.get(t, 0) for t in set(part))
                shares = [decontam.contained(x, held, part) for x in index.parts[item]]
                if score >= decontam.THRESHOLD - 1e-9 and min(shares) >= decontam.OVERLAP:
                    key = doc, index.ids[item]
                    out[key] = max(out.get(key, 0), round(score, 9))
    return out


def test_decontamination(spark, documents, edge, none):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    rows = sorted((r.item_id, r.text) for r in items.collect())
    docs = sorted((r.doc_id, r.text) for r in documents.collect())
    text = rows[0][1].split()
    changed_ = " ".join([*text[:3], "changed", *text[4:]])
    docs += [(10_001, f"{' a b' * 300} {rows[1][1]} {' c d' * 300}"), (10_002, changed_), (10_003, " ".join(text[: len(text) // 2])), (10_004, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = plain_leaks(docs, rows)
    for size in (decontam.INDEX_BYTES, 2000):
        got = decontam.contamination(df, items, size).collect()
        assert {(r.doc_id, r.item_id): round(r.score, 9) for r in got} == want
    assert (10_001, rows[1][0]) in want and not any(d == 10_003 for d, _ in want)
    kept = decontam.decontaminate(df, items)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in {k[0] for k in want})
    assert decontam.contamination(df, items.limit(0)).count() == 0 == decontam.contamination(none, items).count()
    strange = spark.createDataFrame([(None, "one two three"), (1, None), (2, ""), (3, "own line of the first"), (3, "own line of the first")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.contamination(edge, strange).collect()} == {(5, None), (7, 3)}
    assert decontam.decontaminate(edge, strange).columns == edge.columns


def test_edited_items_are_found_as_a_whole(spark):
    asked = " ".join(f"q{i}" for i in range(30))
    rows = [(1, f"{asked}? yes it is so"), (2, f"{asked.replace('q', 'r')}? one two three four five six"),
            (3, " ".join(f"h{i}" for i in range(20)) + "? " + " ".join(f"k{i}" for i in range(20)))]
    items = spark.createDataFrame(rows, "item_id long, text string")
    docs = [(1, "yes it was so"), (1, "yes it is"), (1, ""), (2, "one two three four 5 six"), (2, "one two three four five")]
    texts = [f"x y z {rows[i - 1][1].split('?')[0]}? {answer}" for i, answer in docs] + [rows[2][1].split("?")[0] + " other" * 20, rows[0][1]]
    found = decontam.contamination(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), items, whole=True).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {*enumerate(i for i, _ in docs), (6, 1)}
    assert {(r.doc_id, r.question_overlap, r.answer_overlap) for r in found if r.doc_id < 3} == {(0, 1.0, 0.0), (1, 1.0, 0.0), (2, 1.0, 0.0)}


def test_block_max_wand_finds_all():
    rng = np.random.default_rng(7)
    vocab = [f"t{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab, rng.integers(3, 12), p=(w := 1 / np.arange(1, 61)) / w.sum()))) for i in range(400)]
    words = [decontam.terms_of(t) for _, t in items]
    frequency = {}
    for w in words:
        for t in set(w):
            frequency[t] = frequency.get(t, 0) + 1
    index = decontam.Index(items, frequency, 400, sum(map(len, words)) / 400, threshold=0.5)
    for _ in range(60):
        terms = {index.vocab[t] for t in {v.encode() for v in rng.choice(vocab, 9)} if t in index.vocab}
        want = {}
        for t in terms:
            for item, weight in zip(*index.lists[t][:2]):
                want[item] = want.get(item, 0) + weight
        assert {i for i, _ in index.search(terms)} == {i for i, s in want.items() if s >= 0.5 - 1e-9}
