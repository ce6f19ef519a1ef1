"""The pool of remembered pieces: bounded, and the same ids however often it forgets."""

import public_tokenizers
import pyarrow as pa
import pytest

from rowmill.llm.packing import Pool
from rowmill.llm.tokens import encode

BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("most", [20, 60, 10_000])
def test_a_full_pool_keeps_what_came_again(most):
    pool = Pool(BYTES, 1, most)
    for batch in range(12):
        texts = [f"same words again, new{batch}x{i} and\nodd{batch}  gap{i}." for i in range(6)]
        want = [[*ids, 1] for ids in encode(BYTES, texts)]
        assert [ids.tolist() for ids in pool.encoded(pa.array(texts))] == want
        size = len(pool.lens)
        assert len(pool.starts) == len(pool.again) == size == len(pool.words) + len(pool.heads)
    if most < 10_000:
        # What a batch brings may stand above the limit until the next one begins.
        assert size < 150
    if most == 60:
        pool.shrink()
        assert "words" in pool.words and "new0x0" not in pool.words and "new11x0" not in pool.words
