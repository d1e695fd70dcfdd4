"""Operator 9 against all pairs of a small table."""

import re

import numpy as np
import pytest

from wattline.llm import ngram_join
from wattline.llm.common import components

SCHEMA = "doc_id long, text string, th string, n int"
WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                group[top(i)] = top(j)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if top(k) == top(i) and rows[k][0] is not None]
        out.append((r[0], len(sets[i]), r[0] if not sets[i] else min(ids, default=None)))
    return sorted(out, key=repr)


def make_rows(seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    text = lambda n: list(rng.choice(vocabulary, n))
    rows, passage = [], text(30)

    def add(words):
        rows.append((len(rows), " ".join(words), "x", 1))

    for _ in range(25):
        add(text(int(rng.integers(1, 60))) + (passage if rng.random() < 0.5 else []))
    for size in (40, 90, 160):
        origin = text(size)
        for _ in range(22):      # copies with changes around the border of similarity
            copy = list(origin)
            for _ in range(int(rng.integers(0, max(2, size // 22)))):
                copy[int(rng.integers(0, len(copy)))] = str(rng.integers(0, 10**9))
            add(copy)
    walk = text(120)
    for _ in range(25):          # a chain: each links with its neighbours only
        walk = list(walk)
        walk[int(rng.integers(0, len(walk)))] = str(rng.integers(0, 10**9))
        walk[int(rng.integers(0, len(walk)))] = str(rng.integers(0, 10**9))
        add(walk)
    rows += [(1000, None, "", None), (1001, "", "", 1), (1002, " \t\n", "", 1), (1003, "One two", "", 1),
             (1004, "one\ttwo", None, 1), (1005, "two one", "", 1), (None, "ONE TWO", "", 1), (None, "alone here", "", 1)]
    rows += [rows[40], rows[40], (1010, rows[40][1].upper(), "", 1), (1011, "é" * 300_000, "", 1), (1012, "a " * 50_000, "", 1)]
    rng.shuffle(rows)
    return [(None if r[0] is None else int(r[0]), *r[1:]) for r in map(tuple, rows)]


@pytest.mark.parametrize("seed,bands", [(1, 4), (2, 4), (3, 1), (4, 0)])
def test_groups_match_all_pairs(spark, monkeypatch, seed, bands):
    rows = [r for r in make_rows(seed)]
    rows = [(None if r[0] is None else int(r[0]), r[1], r[2], None if r[3] is None else int(r[3])) for r in rows]
    if bands == 0:               # hardly any leader: the bounds have to find everything
        monkeypatch.setattr(ngram_join, "ROWS_PER_BAND", 12)
    monkeypatch.setattr(ngram_join, "BANDS", max(1, bands))
    got = ngram_join.groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_one_document_of_each_group_stays(spark):
    rows = [(1, "a b c d e f", "x", 1), (2, "A b c d e f", "y", 2), (3, None, "z", 3), (4, "", "z", 4),
            (5, "q r s t u", "z", 5), (5, "q r s t u", "z", 5), (None, "m n", "k", None)]
    kept = ngram_join.one_of_each_group(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "th", "n"]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(
        [rows[0], rows[2], rows[3], rows[4], rows[6]], key=repr)


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(500, 501), (7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got[60] == 0 and got[139] == 100 and got[501] == 500 and len(got) == 61 + 40 + 2


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ngram_join.groups(empty).count() == 0
    assert ngram_join.one_of_each_group(empty).count() == 0


@pytest.mark.parametrize("size", [3])
def test_long_lists_in_chunks(spark, monkeypatch, size):
    monkeypatch.setattr(ngram_join, "LIST", size)
    monkeypatch.setattr(ngram_join, "ROWS_PER_BAND", 12)
    rows = make_rows(5)
    got = ngram_join.groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def near_copies(n):
    """Texts with two words of one origin changed: most pairs lie under the threshold, some link."""
    rng = np.random.default_rng(6)
    origin = [f"o{k}" for k in range(60)]
    rows = []
    for i in range(n):
        copy = list(origin)
        for at in rng.choice(60, 2, replace=False):
            copy[at] = f"x{i}y{at}"
        rows.append((i, " ".join(copy), "", 1))
    return rows


def test_near_copies_under_the_threshold_emit_no_quadratic_rows(spark, monkeypatch):
    emitted = []
    was = ngram_join._open_leader_pairs

    def counted(entries):
        found = ngram_join.save(was(entries))
        emitted.append(found.count())
        return found

    monkeypatch.setattr(ngram_join, "_open_leader_pairs", counted)
    for n in (250, 500):
        rows = near_copies(n)
        got = ngram_join.groups(spark.createDataFrame(rows, SCHEMA)).collect()
        assert sorted(map(tuple, got), key=repr) == brute(rows)
    assert emitted[1] <= 500 * 8 and emitted[1] < 0.1 * 500 * 499 / 2


def test_parities_bound_the_difference():
    import pyarrow as pa
    from wattline.llm.textbytes import Texts
    texts = [t for _, t, *_ in near_copies(40)]
    doc, hashes = ngram_join.shingle_sets(Texts(pa.array(texts)))
    odd = ngram_join.parities(doc, hashes, len(texts))
    sets = [shingles(t) for t in texts]
    for i in range(40):
        for j in range(i):
            differ = int(np.bitwise_count(odd[i] ^ odd[j]).sum())
            assert differ <= len(sets[i] ^ sets[j]) and (differ - len(sets[i] ^ sets[j])) % 2 == 0
