"""Operator 7: tokens against the tokenizer file, packings for validity and size."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wattline.llm import packing

SCHEMA = "doc_id long, text string, piece string, place int"


def check_packing(counts, patterns, capacity):
    total = Counter()
    for pattern, n in patterns.items():
        assert n > 0 and sum(pattern) <= capacity
        for length in pattern:
            total[length] += n
    assert total == counts


@pytest.mark.parametrize("seed", range(6))
def test_patterns_hold_every_piece(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 3000))
    counts = Counter(rng.integers(1, 101, n).tolist())
    start = packing.best_fit(counts, 100)
    check_packing(counts, start, 100)
    found = packing.local_search(start, 100)
    check_packing(counts, found, 100)
    assert sum(found.values()) <= sum(start.values())
    assert sum(found.values()) >= -(-sum(k * v for k, v in counts.items()) // 100)


def test_local_search_empties_bins():
    """Three bins that no move alone can empty: an exchange makes two."""
    start = Counter({(6, 3): 1, (5, 2): 1, (2, 2): 1})
    assert sum(packing.local_search(start, 10).values()) == 2


def test_trades():
    assert packing._trade((6,), (3, 2), 10) == ((6, 3), (2,))
    assert packing._trade((6, 2), (4,), 10) == ((6, 4), (2,))
    assert packing._trade((5, 3), (2, 2), 10) is not None
    assert packing._trade((10,), (4,), 10) is None


TEXTS = [None, "", "word " * 3000, "Hello, world! <|endoftext|> é文", "a b c d " * 90, "x\n" * 2000, "tail"]


def test_pieces_and_places(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(TEXTS * 3)] + [(None, "no id", None, None), (4, TEXTS[4], "y", 0)]
    got = packing.packed(spark, spark.createDataFrame(rows, SCHEMA)).toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = []
    for doc, text, _, _ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    rows_got = [(None if d != d else int(d), int(p), int(s), int(n), int(c)) for d, p, s, n, c in zip(
        got.doc_id, got.piece, got.start, got.length, got.ids_crc32)]
    assert sorted(rows_got, key=repr) == sorted(want, key=repr)
    for _, one in got.groupby("sequence_id"):
        one = one.sort_values("offset")
        assert one.offset.tolist() == [0, *one.length.cumsum().tolist()[:-1]]
        assert one.length.sum() <= 1024


def test_empty_table(spark):
    assert packing.packed(spark, spark.createDataFrame([], SCHEMA)).count() == 0
