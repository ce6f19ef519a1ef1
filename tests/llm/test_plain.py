"""Operators without SQL beside plain Python from the text to the result."""

import math
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_fixtures import SMALL, documents, edge, none  # noqa: F401
from rowmill.llm import line_rules as R, toxicity as X
from test_dedup import plain_fingerprint
from test_entry import pipeline

BLANK = "[\x20\x09-\x0d]"


# --- line rules


def plain_line_fails(line):
    short = len([w for w in re.split(" +", re.sub("[\t\x0b\x0c\r]", " ", line).strip(" "))]) <= 4 and not re.search(R.SENTENCE_END, line)
    return (len(re.findall(R.SHOUTS, line)) >= 2 or short or len(re.findall(R.MENU_MARKS, line)) >= 2
            or bool(re.search(R.MENU_WORDS, line)) or bool(re.search(R.BOILERPLATE, line)))


def plain_verdict(text):
    """Words, lines that fail, the share lost and whether the text is kept."""
    text = text or ""
    words = [w for w in re.split(f"{BLANK}+", text) if w]
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i:i + 3])].append(i)
    repeated = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(3)}
    failed_base = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    lines = text.split("\n")
    good = [x for x in lines if not (re.search(f"[^\x20\x09-\x0d]", x) and plain_line_fails(x))]
    chars = sum(map(len, words))
    left = len(re.sub(BLANK, "", "\n".join(good)))
    lost = 1 - left / chars if chars else 0.0
    return len(words), len(repeated), len(lines) - len(good), "\n".join(good), round(lost, 9), not failed_base and lost <= 0.3


@pytest.mark.parametrize("name", ["edge", "documents"])
def test_line_verdicts_beside_plain_python(name, request):
    df = request.getfixturevalue(name)
    rows = R.clean_lines(df.select("doc_id", "text")).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_repeat_words, r.n_lines_failed, r.clean_text, round(r.lost, 9), r.kept) for r in rows), key=str)
    assert got == sorted(((r.doc_id, *plain_verdict(r.text)) for r in df.collect()), key=str)


# --- toxicity


def plain_scores(docs, labels):
    """Scores from the texts and labels alone, step by step."""
    own = {}
    for doc, toxic in labels:
        if doc is not None and toxic is not None and zlib.crc32(str(doc).encode()) % 3 != 1:
            own[doc] = max(own.get(doc, 0), toxic)
    texts = [(doc, X.words_of((text or "").encode()), own.get(doc)) for doc, text in docs]
    counts = defaultdict(lambda: [0, 0, 0])
    for _, words, label in texts:
        for word in set(words):
            for i, hit in enumerate((label == 1, label == 0, True)):
                counts[word][i] += hit
    beginnings = defaultdict(lambda: [0, 0, 0])
    start = lambda word: word.decode()[:X.PREFIX_CHARS]
    for word, c in counts.items():
        for i in range(3):
            beginnings[start(word)][i] += c[i]
    toxic, clean = sum(c[0] for c in counts.values()), sum(c[1] for c in counts.values())
    base = min(max((toxic + 0.5) / (toxic + clean + 1), 1e-6), 1 - 1e-6)
    logit = math.log(base / (1 - base))

    def posterior(c, prior):
        mass = X.PRIOR + X.CORPUS_PRIOR * c[2]
        return (c[0] + mass * prior) / (c[0] + c[1] + mass)

    odds = lambda p: math.log(p / (1 - p)) - logit - X.DRIFT
    score = {w: odds(posterior(c, posterior(beginnings[start(w)], base))) for w, c in counts.items()}
    # A word below zero is without a score, as is one whose beginning alone would score.
    bins = defaultdict(float)
    for word, s in score.items():
        if s > 0:
            bins[math.floor(s * 100 + 0.5) / 100] += counts[word][1] + 0.1
    total = clean + 1.0 + sum(bins.values())
    low, high = 0.01, 5.0
    for _ in range(60):
        mid = (low + high) / 2
        value = sum(w / total * math.exp(mid * s) for s, w in bins.items()) + (1 - sum(bins.values()) / total) * math.exp(-mid * X.DRIFT)
        low, high = (mid, high) if value < 1 else (low, mid)
    rate, found = low, []
    for doc, words, label in texts:
        places, up = [], []
        for i, word in enumerate(words):
            if score[word] > 0:
                places.append(i)
                up.append(0.0 if i and words[i - 1] == word else score[word])
        parts = [s for _, _, s in X.maximal_segments(places, up)]
        found.append((doc, label, max(1, len(words)), parts))
    clean_rows = [(n, max(parts, default=0.0)) for _, label, n, parts in found if label == 0]
    level = math.log(len(clean_rows) / sum(n * math.exp(-rate * most) for n, most in clean_rows))

    def above(n, parts):
        bar = math.log(n) + level
        sums = sum(v for v in (s * rate - bar for s in parts) if v > 0)
        return sums if sums > 0 else max(parts, default=0.0) * rate - bar

    tally = defaultdict(float)
    for _, label, n, parts in found:
        if label is not None:
            v = min(max(above(n, parts), -30.0), 300.0)
            tally[math.copysign(math.floor(abs(v) * 10 + 0.5) / 10, v), label] += 1
    slope, offset = X.logistic(np.array([x for x, _ in tally]), np.array([y for _, y in tally]), np.array(list(tally.values())))
    return {doc: 1 / (1 + math.exp(-min(max(above(n, parts) * slope + offset, -700), 700))) for doc, _, n, parts in found}


def test_toxicity_scores_beside_plain_python(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    want = plain_scores([(r.doc_id, r.text) for r in docs.collect()], [(r.doc_id, r.toxic) for r in labels.collect()])
    got = {r.doc_id: r.score for r in X.score(docs, labels).collect()}
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in got) < 1e-6


def test_the_logistic_curve_is_the_best_one():
    rng = np.random.default_rng(2)
    x = rng.normal(size=400)
    y = (rng.random(400) < 1 / (1 + np.exp(-(1.7 * x - 0.6)))).astype(int)
    loss = lambda a, b: np.log1p(np.exp(-(2 * y - 1) * (a * x + b))).sum() + 0.005 * a * a
    a, b = X.logistic(x, y, np.ones(400))
    assert all(loss(a, b) <= loss(a + da, b + db) + 1e-9 for da in (-0.01, 0, 0.01) for db in (-0.01, 0, 0.01))


# --- the pipeline's near copies and packing


def plain_groups(rows):
    """The least doc_id of the group of each document: fingerprints at most two bits apart, over all pairs."""
    prints = {i: plain_fingerprint(text) for i, text in rows}
    root = {i: i for i in prints}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {i: top(i) for i in ids}


def test_near_copies_of_the_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    groups = plain_groups(rows)
    assert len(set(groups.values())) < len(groups)
    kept = pipeline().near_copies(spark, docs, SMALL)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted((i, t) for i, t in rows if groups[i] == i)


def test_packing_of_the_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r.doc_id: [*known.encode(r.text or "", add_special_tokens=False).ids, 1] for r in docs.collect()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in pipeline().packed(spark, docs, SMALL).collect():
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert len(part) == r.length and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == ids.keys()
    for doc, spans in pieces.items():  # each id in exactly one piece
        spans.sort()
        assert [s for s, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))] and sum(n for _, n in spans) == len(ids[doc])
    for spans in sequences.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))] and sum(n for _, n in spans) <= 2048
    total = sum(map(len, ids.values()))
    assert len(sequences) <= -(-total // 2048) + 1 + total // 2048 // 20  # at most a twentieth of padding
