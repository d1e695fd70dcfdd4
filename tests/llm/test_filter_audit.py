"""Operator 11 against plain Python sets, its merges against numpy, defined cases."""

import re
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from wattline.llm import filter_audit as fa

WORD = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, lang string, part string, bits int, first string"
LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels):
    docs = [(i, t or "", p or "") for i, t, p, *_ in docs]
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t] = min(i, first.get(t, i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    fails = []
    for i, t, _ in docs:
        words = WORD.findall(t)
        fails.append({
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and i > first[t]})
    out = set()
    for part in {p for *_, p in docs}:
        mine = [k for k, d in enumerate(docs) if d[2] == part]
        rows, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = set(mine)
            for step, f in enumerate(order, 1):
                bad = {k for k in mine if fails[k][f]}
                gone = bad & left
                left -= gone
                shapley[f] += len(gone)
                rows.append((part, "".join(order), step, len(left), len(gone), len(bad - gone),
                             sum(all(fails[k][o] == (o == f) for o in "ABCDE") for k in mine),
                             sum(docs[k][0] in good for k in gone), sum(docs[k][0] in toxic for k in gone), f))
        out |= {(*r[:-1], shapley[r[-1]]) for r in rows}
    return out


def got(spark, docs, labels):
    found = fa.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert len({(r.part, r.filter_order) for r in found}) * 5 == len(found)
    return {(r.part, r.filter_order, r.step, r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost,
             r.shapley) for r in found}


def corpus():
    rng = np.random.default_rng(11)
    words = [f"w{k}" for k in range(400)] + ["É", "日本", "A#", "B%"]
    texts = [None, "", " \t\n", "A", "x " * 300, "Ab cd| " * 90, "long" * 50_000]
    for _ in range(150):
        n = int(rng.choice([5, 150, 199, 200, 260]))
        text = " ".join(rng.choice(words[:int(rng.choice([30, 400, 404]))], n))
        texts.append(text.title() if rng.random() < 0.4 else text)
    texts += [texts[k] for k in rng.integers(0, 30, 120)] + ["hot text"] * 60
    rows = [(int(i), t, [None, "", "en", "fr"][int(rng.integers(4))]) for i, t in zip(rng.permutation(len(texts)), texts)]
    rows += [rows[3], rows[3], (rows[9][0], "other # text", "en"), *[(None, "hot text", "en")] * 5, (None, "own", "fr")]
    return [(*r, "clash", 1, "clash") for r in rows], [(int(i), int(rng.integers(2)), int(rng.integers(2)))
                                                     for i in rng.permutation(len(rows))[:200]]


def test_every_order_of_every_part(spark):
    docs, labels = corpus()
    labels += [labels[0], (labels[1][0], None, None), (None, 1, 1), (10**9, 1, 1)]
    assert got(spark, docs, labels) == brute(docs, labels)


@pytest.mark.parametrize("size,hot", [(7, 3), (1, 1000)])
def test_small_ranges_and_hot_texts(spark, monkeypatch, size, hot):
    monkeypatch.setattr(fa, "RANGE", size)
    monkeypatch.setattr(fa, "HOT_SHARE", hot)
    docs, labels = corpus()
    docs = docs[:60] + docs[-8:]
    assert got(spark, docs, labels) == brute(docs, labels)


def test_posting_lists_are_sorted_whole_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(fa, "RANGE", 16)
    docs, labels = corpus()
    lists = fa.postings(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert sum(r.n for r in lists) == len(docs) and all(len(r["ids"]) <= 16 and sum(r.weights) == r.n for r in lists)
    for r in lists:
        known = [i for i in r["ids"] if i is not None]
        assert known == sorted(known) and (r.first_id, r.last_id) == (r["ids"][0], r["ids"][-1])
        assert all(r[f] == sorted(set(r[f])) for f in [*"ABCDE", "good", "toxic"])


def test_empty_tables(spark):
    docs, labels = corpus()
    assert got(spark, [], labels) == set()
    assert got(spark, docs[:20], []) == brute(docs[:20], [])


lists_ = st.lists(st.lists(st.integers(0, 60), max_size=40).map(lambda x: np.array(sorted(set(x)), np.int64)),
                  min_size=1, max_size=5)


@given(lists_, st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_merges(lists, run):
    was, fa.RUN = fa.RUN, run
    try:
        sets = [set(x.tolist()) for x in lists]
        assert fa.union(lists).tolist() == sorted(set().union(*sets))
        assert fa.difference(lists[0], lists[1:]).tolist() == sorted(sets[0].difference(*sets[1:]))
        assert fa.common(lists[0], lists[-1]).tolist() == sorted(sets[0] & sets[-1])
        assert all(len(x) <= run for found in fa.id_ranges(lists) for x in found)
    finally:
        fa.RUN = was


@given(st.lists(st.integers(0, 50), max_size=60), st.integers(0, 60), st.integers(0, 55))
@settings(max_examples=200, deadline=None)
def test_gallop(values, at, bound):
    ids = np.array(sorted(values), np.int64)
    at = min(at, len(ids))
    assert fa.gallop(ids, at, bound) == max(at, int(np.searchsorted(ids, bound)))
