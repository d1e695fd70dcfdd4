"""Operator 3 against brute force: recall, exact distances, defined cases."""

import math

import numpy as np
import pytest

from wattline.llm import neighbours
from wattline.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, row string, cell int"


def brute(ids, vectors, k=10, every=100):
    out = {}
    for q in range(len(ids)):
        if ids[q] % every:
            continue
        gap = vectors - vectors[q]
        distance = np.sqrt((gap * gap).sum(axis=1))
        order = [i for i in np.lexsort((ids, distance)) if i != q][:k]
        out[int(ids[q])] = [(int(ids[i]), float(distance[i])) for i in order]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r["rank"]
    return out


@pytest.mark.parametrize("cell_rows", [4096, 100])
def test_recall_on_the_table(spark, cell_rows):
    vectors = table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = vectors.orderBy("vec_id").collect()
    want = brute(np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64), every=10)
    got = by_query(neighbours.nearest_neighbours(vectors, every=10, cell_rows=cell_rows).collect())
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    for q, found in got.items():
        truth = dict(want[q])
        assert all(math.isclose(score, truth[i], rel_tol=1e-12) for i, score in found if i in truth)


def test_defined_cases(spark, monkeypatch):
    rows = [(100, [1.0, 0.0], "x", 1), (200, [0.0, 0.0], "", 1), (300, None, "", 1), (400, [1.0, None], "", 1),
            (500, [float("nan"), 1.0], "", 1), (600, [float("inf"), 1.0], "", 1), (700, [1.0], "", 1), (800, [], "", 1),
            (None, [1.0, 0.0], "", 1), (3, [1.0, 0.5], None, None), (2, [1.0, 0.5], "", 1), (100, [1.0, 0.0], "", 2)]
    got = neighbours.nearest_neighbours(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got)) == sorted([(100, 1, 100, 0.0, 3), (100, 2, 2, 0.5, 0), (100, 3, 3, 0.5, 0)] * 2)
    empty = spark.createDataFrame([], SCHEMA)
    assert neighbours.nearest_neighbours(empty).count() == 0


def test_large_group_of_equal_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0], "", 0) for i in range(1, 700)] + [(1000 + i, [float(i), 1.0, 0.5], "", 0) for i in range(1, 60)]
    rows += [(2000, [1.0, 2.0, 3.0], "", 0), (2100, [30.5, 1.0, 0.5], "", 0)]
    got = by_query(neighbours.nearest_neighbours(spark.createDataFrame(rows, SCHEMA), cell_rows=64).collect())
    want = brute(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]))
    assert got[2000] == want[2000] == [(i, 0.0) for i in range(1, 11)]
    assert got[100][:9] == [(i, 0.0) for i in range(1, 10)]
    assert [i for i, _ in got[2100]] == [i for i, _ in want[2100]]


def recall_and_share(spark, ids, vectors, every, **how):
    """Recall, and the share of all vectors that a query verified."""
    rows = spark.createDataFrame([(int(i), [float(x) for x in v], "", 0) for i, v in zip(ids, vectors)],
                                 "vec_id long, embedding array<double>, row string, cell int")
    found = neighbours.nearest_neighbours(rows, every=every, **how).collect()
    got, want = by_query(found), brute(ids, vectors, every=every)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    return hits / sum(map(len, want.values())), sum(r.verified for r in found) / (len(want) * len(ids))


def test_the_stopping_test_ends_searches_on_the_table(spark):
    rows = table(spark, "/root/testdata/sf0.1", "embeddings").orderBy("vec_id").collect()
    recall, share = recall_and_share(spark, np.array([r.vec_id for r in rows]),
                                     np.array([r.embedding for r in rows], np.float64), 10)
    assert recall >= 0.9 and share <= 0.4


def test_clustered_vectors_need_few_looks(spark):
    random = np.random.default_rng(5)
    centres = random.standard_normal((60, 64))
    vectors = centres[random.integers(0, 60, 6000)] + 0.1 * random.standard_normal((6000, 64))
    recall, share = recall_and_share(spark, np.arange(6000), vectors, 50, cell_rows=500)
    assert recall >= 0.9 and share <= 0.05
