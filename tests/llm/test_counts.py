"""Token counts, packing and line rules beside plain versions of the same rules."""

import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_fixtures import documents, edge, none  # noqa: F401
from rowmill.llm.line_rules import clean_lines
from rowmill.llm.packing import best_fit, pack
from rowmill.llm.tokens import count_tokens

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SPACE = r"[\x20\x09-\x0D]"


@pytest.mark.parametrize("name", ["edge", "documents", "none"])
def test_token_counts(name, request):
    df = request.getfixturevalue(name)
    known = Tokenizer.from_file(WORDS)
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(known.encode(r.text or "", add_special_tokens=False).ids)) for r in df.collect())
    out = count_tokens(df, WORDS)
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in out.collect()) == want
    assert set(out.columns) == set(df.columns) - {"text"} | {"n_bytes", "n_tokens"}


def test_token_counts_uncut(edge):
    known = Tokenizer.from_file(BYTES)
    got = sorted((r.doc_id or -1, r.n_tokens) for r in count_tokens(edge, BYTES, whole=True).collect())
    assert got == sorted((r.doc_id or -1, len(known.encode(r.text or "").ids)) for r in edge.collect())


@pytest.mark.parametrize("name", ["edge", "documents", "none"])
@pytest.mark.parametrize("group", [40, 20_000])
def test_packing(name, group, request):
    df = request.getfixturevalue(name)
    known = Tokenizer.from_file(BYTES)
    want = sorted([*known.encode(r.text or "", add_special_tokens=False).ids, 1] for r in df.collect())
    crcs = defaultdict(int)
    for ids in want:
        for at in range(0, len(ids), 2048):
            crcs[zlib.crc32(np.array(ids[at:at + 2048], "<u4").tobytes()), at, min(2048, len(ids) - at), len(ids)] += 1
    rows = pack(df, BYTES, group_pieces=group).collect()
    for r in rows:
        crcs[r.ids_crc32, r.start, r.length, r.doc_tokens] -= 1
    assert not any(crcs.values())
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for spans in sequences.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
        assert sum(n for _, n in spans) <= 2048


def test_best_fit_takes_the_tightest():
    lengths = sorted((int(x) for x in np.random.default_rng(1).integers(1, 101, 3000)), reverse=True)
    bins, offsets = best_fit(lengths, 100)
    rooms, slow = [], []
    for n in lengths:
        fits = [(room, i) for i, room in enumerate(rooms) if room >= n]
        room = min(fits)[0] if fits else None
        if room is None:
            rooms.append(100 - n)
            slow.append(100)
        else:
            rooms[min(fits)[1]] -= n
            slow.append(room)
    assert [100 - o for o in offsets] == slow


def plain_counts(text):
    text = text or ""
    words = [w for w in re.split(SPACE + "+", text) if w]
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i:i + 3])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


@pytest.mark.parametrize("name", ["edge", "documents", "none"])
def test_base_counts(name, request):
    df = request.getfixturevalue(name)
    got = [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in clean_lines(df).collect()]
    assert sorted(got) == sorted(plain_counts(r.text) for r in df.collect())


def test_line_rules(spark):
    prose = "Plain words in a sentence that goes on for a while and then ends well."
    text = "\n".join([prose] * 6 + ["home | about | contact | more", "All rights reserved.", "BUY!! NOW!! CHEAP!!", "short one"])
    bad = "\n".join([prose, *["x%%% y*** z&&& w$$$ and so on until it ends here with more words" for _ in range(9)]])
    rows = clean_lines(spark.createDataFrame([(1, text), (2, bad), (3, None)], "id int, text string")).collect()
    assert [(r.id, r.kept, r.n_lines_failed) for r in sorted(rows)] == [(1, False, 4), (2, False, 9), (3, False, 0)]
    assert sorted(rows)[0].clean_text == "\n".join([prose] * 6)
    assert sorted(rows)[0].base_failed  # the sentence repeats
