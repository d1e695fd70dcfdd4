"""Hashes of byte ranges: equal exactly for equal bytes, also for words that defeat powers of two as a modulus."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from wattline.llm import quality, textbytes as tb


def thue_morse(bits):
    word = np.zeros(1, np.uint8)
    for _ in range(bits):
        word = np.concatenate((word, 1 - word))
    return word


@pytest.mark.parametrize("one,other", [("a", "b"), ("the ", "and "), ("xxxxxxxaxxxxxxx", "xxxxxxxbxxxxxxx")])
def test_thue_morse_words_and_their_complements_differ(one, other):
    word = thue_morse(10)
    texts = ["".join((one, other)[k] for k in w) for w in (word, 1 - word)]
    found = tb.Texts(pa.array(texts))
    assert len(set(found.range_hasher()(found.starts, found.ends).tolist())) == 2


def test_different_lines_are_not_duplicates(spark):
    word = thue_morse(10)
    lines = ["".join("ab"[k] for k in w) for w in (word, 1 - word)]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(lines[:1] * 2))], "doc_id long, text string")
    assert {r.doc_id: r.n_dup_lines for r in quality.verdicts(docs).collect()} == {1: 0, 2: 1}


@given(st.lists(st.integers(0, tb._PRIME - 1), min_size=1, max_size=20), st.integers(0, tb._PRIME - 1))
@settings(max_examples=300, deadline=None)
def test_products(values, factor):
    a = np.array(values, np.uint64)
    assert tb.times(a, np.full(len(a), factor, np.uint64)).tolist() == [v * factor % tb._PRIME for v in values]


def test_prefix_sums_over_many_runs():
    rng = np.random.default_rng(1)
    values = rng.integers(1, 2**31, 3 * tb._RUN + 5, dtype=np.uint64)
    values[:tb._RUN] = 2**31 - 1
    powers, inverses = tb._power_tables(len(values) + 1)
    sums = tb._prefix_sums(values, powers)
    total, p = 0, 1
    for k in range(len(values)):
        assert powers[k] == p and (int(inverses[k]) * p) % tb._PRIME == 1
        total = (total + int(values[k]) * p) % tb._PRIME
        p = p * tb._BASE % tb._PRIME
        assert sums[k + 1] == total


@given(st.text("abAB é\n", max_size=40), st.integers(0, 40), st.integers(0, 40), st.integers(0, 12))
@settings(max_examples=300, deadline=None)
def test_equal_bytes_equal_hash(text, a, b, size):
    found = tb.Texts(pa.array([text]))
    n = len(found.data)
    a, b = min(a, n), min(b, n)
    a2, b2 = min(a + size, n), min(b + size, n)
    hashes = found.range_hasher()(np.array([a, b]), np.array([a2, b2]))
    assert (hashes[0] == hashes[1]) == (found.data[a:a2].tobytes() == found.data[b:b2].tobytes())
    lower = found.range_hasher(lower=True)(np.array([a, b]), np.array([a2, b2]))
    assert (lower[0] == lower[1]) == (found.data[a:a2].tobytes().lower() == found.data[b:b2].tobytes().lower())


def test_slices_longer_than_usual():
    found = tb.Texts(pa.array(["ab" * (tb._KEPT_POWERS // 2 + 5)]))
    n = len(found.data)
    hashes = found.range_hasher()(np.array([0, n - 100, n - 99]), np.array([100, n, n - 1]))
    assert hashes[0] == hashes[1] != hashes[2] and len(tb._powers[0]) <= tb._KEPT_POWERS
