"""ML-04: the pruned search against brute force, and how much it prunes."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from wattline.ml import knn


def brute(train, test, k):
    """Prediction of every test row whose features are whole, among whole training rows."""
    train = [r for r in train if all(v is not None and np.isfinite(v) for v in r[1])]
    ids, x, y = (np.array(c) for c in zip(*((i, v, t) for i, v, t in train)))
    out = {}
    for i, q in test:
        if all(v is not None and np.isfinite(v) for v in q):
            d = knn.squared(np.array([q], float), x.astype(float))[0]
            out[i] = float(np.mean(y[np.lexsort((ids, d))[:k]]))
    return out


def predicted(spark, train, test, k, block_rows, width):
    names = [f"f{j}" for j in range(width)]
    schema = ", ".join(f"{n} double" for n in names)
    tr = spark.createDataFrame([(i, *x, y) for i, x, y in train], f"id long, {schema}, y double")
    te = spark.createDataFrame([(i, *x) for i, x in test], f"id long, {schema}")
    return {r["id"]: r["prediction"] for r in knn.knn_predict(tr, te, names, "y", "id", k, block_rows).collect()}


def check(spark, train, test, k=7, block_rows=32, width=2):
    got, want = predicted(spark, train, test, k, block_rows, width), brute(train, test, k)
    assert got.keys() == want.keys()
    assert all(got[i] == pytest.approx(want[i], rel=1e-12) for i in want)


@pytest.mark.parametrize("block_rows", [16, 100, 16_384])
def test_clusters_ties_and_a_hot_vector(spark, block_rows):
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 0.3, (150, 2)) for c in ((0, 0), (9, 1), (4, 8))] +
                            [rng.integers(0, 5, (150, 2)).astype(float), np.full((300, 2), 2.0)])
    ids = rng.permutation(len(points))
    train = [(int(i), tuple(map(float, p)), float(i % 11)) for i, p in zip(ids, points)]
    test = [(10_000 + j, tuple(map(float, p))) for j, p in enumerate(
        np.concatenate([rng.normal(4, 5, (60, 2)), rng.integers(0, 6, (40, 2)), np.full((80, 2), 2.0), [[500.0, -300.0]]]))]
    check(spark, train, test, block_rows=block_rows)


def test_many_features(spark):
    rng = np.random.default_rng(2)
    train = [(i, tuple(map(float, rng.integers(0, 12, 5))), float(rng.normal())) for i in range(700)]
    test = [(i, tuple(map(float, rng.integers(-2, 14, 5)))) for i in range(60)]
    check(spark, train, test, width=5)


def test_rows_without_whole_features_and_own_cells_of_fewer_rows_than_k(spark):
    rng = np.random.default_rng(3)
    train = [(i, (float(rng.normal()), float(rng.normal())), float(i)) for i in range(200)]
    train += [(300, (None, 1.0), 1e9), (301, (float("nan"), 0.0), 1e9), (302, (float("inf"), 0.0), 1e9), (303, (-0.0, 0.0), 5.0)]
    test = [(1, (0.0, -0.0)), (2, (None, 1.0)), (3, (float("nan"), 1.0)), (4, (float("-inf"), 1.0)), (5, (50.0, 50.0))]
    check(spark, train, test, k=25, block_rows=8)
    check(spark, train[:3], test, k=7, block_rows=8)


def test_no_training_rows_or_no_test_rows(spark):
    row = [(1, (1.0, 2.0), 3.0)]
    assert predicted(spark, row, [], 7, 16, 2) == {}
    assert predicted(spark, [], [(1, (1.0, 2.0))], 7, 16, 2) == {}


def test_a_sample_smaller_than_the_table(spark, monkeypatch):
    monkeypatch.setattr(knn, "SAMPLE", 128)
    rng = np.random.default_rng(4)
    train = [(i, tuple(map(float, rng.random(2))), float(i % 7)) for i in range(3000)]
    test = [(i, tuple(map(float, rng.random(2)))) for i in range(50)]
    check(spark, train, test, block_rows=40)          # 16 cells of about 190 rows, in several chunks each


def test_few_cells_are_visited(spark):
    """On 20,000 vectors in 64 cells a test vector looks at a small part of the pairs."""
    rng = np.random.default_rng(5)
    vectors = rng.random((20_000, 2))
    cells = knn.fit_cells(vectors, 20_000, 320)
    assert cells.many == 64
    x = rng.random((500, 2))
    own = cells.cell(x)
    d = knn.squared(x, vectors)
    reach = np.sort(np.where(cells.cell(vectors)[None, :] == own[:, None], d, np.inf), axis=1)[:, 6]
    who, cell = cells.near(x, reach)
    assert len(who) < 3 * len(x)
    assert len(who) / (len(x) * cells.many) < 0.05
    # What the pruned search leaves out is never a neighbour.
    seen = np.zeros((len(x), cells.many), bool)
    seen[who, cell] = True
    best = np.argsort(d, axis=1, kind="stable")[:, :7]
    assert seen[np.arange(len(x))[:, None], cells.cell(vectors)[best]].all()


def test_shuffled_rows_stay_far_below_all_blocks(spark):
    """Rows that the two searches read (training rows and visits), against every block meeting every block."""
    rng = np.random.default_rng(6)
    n, queries, block = 6000, 600, 100
    frame = lambda m, off: spark.createDataFrame(
        [(off + i, list(map(float, v)), 1.0) for i, v in enumerate(rng.random((m, 2)))], "qid long, x array<double>, y double")
    train, test = frame(n, 0).cache(), frame(queries, n).cache()
    read = spark.sparkContext.accumulator(0)
    was = knn._search

    def counted(k):
        run = was(k)

        def count(batches):
            def seen():
                for b in batches:
                    read.add(b.num_rows)
                    yield b
            yield from run(seen())
        return count

    knn._search = counted
    try:
        knn.nearest(train, test, 2, 7, block).write.format("noop").mode("overwrite").save()
    finally:
        knn._search = was
    # The own cells may be searched twice where an exchange is not reused.
    assert read.value < 3 * n + 6 * queries < 0.2 * n * (queries / block) * 4
    train.unpersist(), test.unpersist()


@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=120),
       st.lists(st.tuples(st.integers(-3, 12), st.integers(-3, 12)), min_size=1, max_size=20), st.integers(1, 9), st.integers(1, 40))
@settings(max_examples=150, deadline=None)
def test_cells_never_hide_a_neighbour(points, queries, k, block_rows):
    t, q = np.array(points, float), np.array(queries, float)
    cells = knn.fit_cells(t, len(t), block_rows)
    own, home = cells.cell(q), cells.cell(t)
    d = knn.squared(q, t)
    for i in range(len(q)):
        reach = cells.reach(q[i:i + 1], int(own[i]), k)
        kth = np.sort(d[i])[k - 1] if len(t) >= k else np.inf
        assert reach[0] >= kth
        _, near = cells.near(q[i:i + 1], np.array([kth]))
        assert set(home[d[i] <= kth]) <= set(near)
