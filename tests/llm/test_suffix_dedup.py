"""Operator 2 against a brute-force count of every window."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from wattline.llm.bwt import repeated_starts
from wattline.llm.suffix_dedup import removal_report, remove_repeats, repeated_ranges

SCHEMA = "doc_id long, text string, anchor string, key int"


def brute(rows, least):
    raws = [(r[0], (r[1] or "").encode()) for r in rows]
    seen = Counter(t[i:i + least] for _, t in raws for i in range(len(t) - least + 1))
    out = []
    for doc, t in raws:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - least + 1):
            if seen[t[i:i + least]] > 1:
                gone[i:i + least] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((gone[1:] < gone[:-1]).sum())
        out.append((doc, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_repeated_starts_against_counts():
    rng = np.random.default_rng(3)
    for _ in range(200):
        least = int(rng.integers(1, 9))
        texts = [rng.integers(97, 97 + rng.integers(1, 4), rng.integers(0, 40)).astype(np.uint8).tobytes()
                 for _ in range(rng.integers(1, 6))]
        ends = np.cumsum([len(t) for t in texts])
        starts = ends - [len(t) for t in texts]
        got = repeated_starts(np.frombuffer(b"".join(texts), np.uint8), starts, ends, least)
        seen = Counter(t[i:i + least] for t in texts for i in range(len(t) - least + 1))
        want = [i + least <= len(t) and seen[t[i:i + least]] > 1 for t in texts for i in range(len(t))]
        assert got.tolist() == want


def make_rows():
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdeé"), rng.integers(1, 8)))
    passage = " ".join(word() for _ in range(80))
    rows = [(i, " ".join(word() for _ in range(rng.integers(1, 150))), "x", i) for i in range(40)]
    rows += [(100 + i, f"{word()} {word()} {passage[i:]} {word()}{i}", None, i) for i in range(25)]
    rows += [(200, passage + passage, "", 1), (201, passage[3:203], "", 1), (202, passage[:199], "", 1)]
    rows += [(300, None, None, None), (301, "", "", 0), (None, "short", "", 0), (None, passage * 2, "", 0)]
    rows += [rows[3]] * 3 + [(999, rows[3][1], "k", 0)]
    rows += [(400, "a" * 9000, "", 0), (401, "xyz " * 600, "", 0), (402, "q" + "a" * 450 + "z", "", 0)]
    return rows


@pytest.mark.parametrize("hot", [4096, 1])
def test_report_matches_brute_force(spark, hot):
    rows = make_rows()
    got = removal_report(spark.createDataFrame(rows, SCHEMA), hot=hot).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 200)


def test_short_strings(spark):
    rows = [(1, "abcabcabd"), (2, "zzabz"), (3, "bdé"), (4, None)]
    got = removal_report(spark.createDataFrame(rows, "doc_id long, text string"), least=2).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 2)


def test_columns_stay_and_text_is_cut(spark):
    rows = [(1, "é" * 150 + "tail", "a", 1), (2, "head" + "é" * 150, "b", None), (3, None, "c", 2)]
    got = remove_repeats(spark.createDataFrame(rows, SCHEMA)).orderBy("doc_id")
    assert got.columns == ["doc_id", "text", "anchor", "key"]
    assert [tuple(r) for r in got.collect()] == [(1, "tail", "a", 1), (2, "head", "b", None), (3, None, "c", 2)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert removal_report(empty).count() == 0
    assert remove_repeats(empty).columns == ["doc_id", "text", "anchor", "key"]
    assert repeated_ranges(empty.selectExpr("cast(key as long) key", "doc_id", "text")).count() == 0
