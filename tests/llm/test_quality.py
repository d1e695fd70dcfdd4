"""Operator 8 against plain Python, and its ledger arithmetic."""

import re
from collections import Counter

import pytest

from wattline.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {p for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for p in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(inside), len(lines), sum(x == y for x, y in zip(words, words[1:])))


TEXTS = [None, "", " \t\r\n\x0b\x0c", "one", "a b c d e a b c d e", "é ü ß x y " * 4, "# * $% & | < >",
         "l1 a\nl1 a\n\n  \nl1 a", "x\n" * 30, "\nstart", "end\n", "a a a a a a a a a a a a",
         "long " * 40_000, "The quick brown fox jumps over the lazy dog near the river bank today.\nSecond line here."]
SCHEMA = "doc_id long, text string, n_words string, row int"


def test_measurements(spark):
    rows = [(i, t, "n", None) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "n", 1), (None, "a b", None, 1)]
    got = {(r.doc_id, r.n_words): r for r in quality.verdicts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows) - 1
    for i, t, _, _ in rows:
        want = brute(t)
        r = got[i, want[0]]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_lines, r.n_echoes) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (r.fail_bits == 0) and not (r.kept and r.base_failed)


def test_ablation_counts(spark):
    entries = spark.createDataFrame([(0,), (1,), (1,), (3,), (4,), (None,)], "fail_bits int").na.drop()
    got = {r.rule: (r.failed, r.only_this, r.kept_without) for r in quality.ablation(entries).collect()}
    assert got["too_few_words"] == (3, 2, 3)
    assert got["repeated_windows"] == (1, 0, 1)
    assert got["symbol_heavy"] == (1, 1, 2)
    assert quality.mask("base") == 3


def test_policy_keeps_rows_as_they_were(spark):
    rows = [(i, t, "n", i) for i, t in enumerate(TEXTS)]
    kept = quality.apply_policy(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "n_words", "row"]
    assert [tuple(r) for r in kept.collect()] == [(13, TEXTS[13], "n", 13)]


@pytest.mark.parametrize("call", [quality.verdicts, quality.apply_policy, quality.ledger])
def test_empty_table(spark, call):
    assert call(spark.createDataFrame([], SCHEMA)).count() == 0
