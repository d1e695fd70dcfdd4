import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.ml import metrics as M
from wattline.ml import registry
from wattline.ml.knn import knn_predict
from wattline.ml.models import linear_regression
from wattline.ml.split import hash_split


def _metrics(spark, rows):
    df = spark.createDataFrame(rows, "label double, prediction double")
    return M.evaluate(df).first()


def test_metric_edges(spark):
    perfect = _metrics(spark, [(1.0, 1.0), (2.0, 2.0)])
    assert perfect["r2"] == 1.0 and perfect["rmse"] == 0.0
    const = _metrics(spark, [(5.0, 5.0), (5.0, 5.0)])
    assert const["r2"] == 1.0
    const_bad = _metrics(spark, [(5.0, 4.0), (5.0, 5.0)])
    assert const_bad["r2"] == 0.0
    zero = _metrics(spark, [(0.0, 1.0), (2.0, 2.0)])
    assert zero["zero_labels"] == 1 and zero["mape"] > 1e10
    one = _metrics(spark, [(3.0, 1.0)])
    assert one["rmse"] == 2.0 and one["n"] == 1
    y = np.array([1.0, 2.0, 4.0, 8.0])
    p = np.array([1.5, 2.0, 3.0, 9.0])
    got = _metrics(spark, list(zip(y.tolist(), p.tolist())))
    r2 = 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert math.isclose(got["r2"], r2, rel_tol=1e-12)
    assert math.isclose(got["mape"], float(np.mean(np.abs((y - p) / (y + 1e-9))) * 100), rel_tol=1e-12)


def test_best_model_rules(spark):
    rows = [("a", 0, 0.5), ("b", 1, 0.9), ("c", 2, 0.9), ("d", 3, float("nan"))]
    m = spark.createDataFrame(rows, "model string, ordinal int, r2 double")
    assert M.best_model(m).first()["best_model"] == "b"
    none = spark.createDataFrame([("a", 0, -999.0), ("b", 1, float("nan"))], "model string, ordinal int, r2 double")
    assert M.best_model(none).first()["best_model"] is None


def test_latest_version_numeric(spark):
    reg = spark.createDataFrame([("m", "9"), ("m", "10"), ("m", "2"), ("n", "x")], "name string, version string")
    out = {r["name"]: r["latest_version"] for r in M.latest_version(reg).collect()}
    assert out == {"m": 10, "n": None}


def test_hash_split_share_and_stability(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    train, test = hash_split(df, F.col("k"))
    share = test.count() / 20000
    assert 0.18 < share < 0.22
    again = hash_split(df.repartition(7), F.col("k"))[1]
    assert sorted(r["k"] for r in test.collect()) == sorted(r["k"] for r in again.collect())


def _brute(train, test, k):
    out = {}
    for qid, qx in test:
        d = sorted((sum((a - b) ** 2 for a, b in zip(qx, tx)), tid, ty) for tid, tx, ty in train)
        out[qid] = sum(t[2] for t in d[:k]) / min(k, len(d))
    return out


@pytest.mark.parametrize("block_rows", [3, 2048])
def test_knn_matches_brute_force_with_ties(spark, block_rows):
    rng = np.random.default_rng(7)
    train = [(i, (float(rng.integers(0, 4)), float(rng.integers(0, 4))), float(i % 5)) for i in range(40)]
    test = [(100 + j, (float(rng.integers(0, 4)), float(rng.integers(0, 4)))) for j in range(9)]
    tr = spark.createDataFrame([(i, x[0], x[1], y) for i, x, y in train], "id long, a double, b double, y double")
    te = spark.createDataFrame([(i, x[0], x[1]) for i, x in test], "id long, a double, b double")
    got = {r["id"]: r["prediction"] for r in knn_predict(tr, te, ["a", "b"], "y", "id", 7, block_rows).collect()}
    want = _brute(train, test, 7)
    assert got.keys() == want.keys()
    for k in want:
        assert math.isclose(got[k], want[k], rel_tol=1e-12)


def test_knn_fewer_train_rows_than_k(spark):
    tr = spark.createDataFrame([(1, 0.0, 1.0), (2, 5.0, 3.0)], "id long, a double, y double")
    te = spark.createDataFrame([(9, 1.0)], "id long, a double")
    assert knn_predict(tr, te, ["a"], "y", "id", 7).first()["prediction"] == 2.0


def test_ols_closed_form(spark):
    rows = [(float(x), 3.0 * x + 2.0 + (0.5 if x % 2 else -0.5)) for x in range(50)]
    df = spark.createDataFrame(rows, "x double, y double")
    m = linear_regression(["x"], "y").fit(df).stages[-1]
    xs = np.array([r[0] for r in rows])
    ys = np.array([r[1] for r in rows])
    slope, icpt = np.polyfit(xs, ys, 1)
    assert math.isclose(m.coefficients[0], slope, rel_tol=1e-9)
    assert math.isclose(m.intercept, icpt, rel_tol=1e-9)


def test_registry_versions(spark, workdir):
    root = os.path.join(workdir, "reg")
    df = spark.createDataFrame([(float(x), 2.0 * x) for x in range(10)], "x double, y double")
    model = linear_regression(["x"], "y").fit(df)
    with pytest.raises(LookupError):
        registry.pull(spark, root, "m")
    assert registry.push(spark, root, "m", model) == 1
    assert registry.push(spark, root, "m", model) == 2
    assert registry.latest(spark, root, "m") == 2
    loaded = registry.pull(spark, root, "m")
    assert loaded.transform(df).select("prediction").first()[0] == pytest.approx(0.0, abs=1e-9)


def test_models_learn_a_learnable_target(spark):
    """Metric range (ML-03/05/07): hourly load that depends on hour and weekend."""
    from wattline.plans.training import run_training
    from pyspark.sql import functions as F
    hours = spark.range(0, 24 * 60).select(
        (F.lit(1325376000) + F.col("id") * 3600).cast("timestamp").alias("ts"), F.col("id"))
    readings = hours.select(
        F.lit("France").alias("perimetre"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"), F.date_format("ts", "HH:mm").alias("heures"),
        (F.lit(50000) + F.hour("ts") * 1000 + F.when(F.weekday("ts") >= 5, -5000).otherwise(0))
        .cast("string").alias("consommation"),
        F.col("id").alias("_row_id"))
    res = run_training(spark, readings, order_cols=["_row_id"])
    m = {r["model"]: r for r in res.metrics.collect()}
    assert m["RandomForest"]["r2"] > 0.95 and m["KNN"]["r2"] > 0.9
    assert m["LinearRegression"]["r2"] > 0.999          # the target is linear in hour and weekend
    assert res.best_r2 == max(r["r2"] for r in m.values())


def test_pushes_at_once_get_versions_of_their_own(spark, workdir):
    from concurrent.futures import ThreadPoolExecutor
    root = os.path.join(workdir, "reg")
    df = spark.createDataFrame([(float(x), 2.0 * x) for x in range(10)], "x double, y double")
    model = linear_regression(["x"], "y").fit(df)
    assert registry.push(spark, root, "m", model) == 1
    with ThreadPoolExecutor(3) as pool:
        versions = list(pool.map(lambda _: registry.push(spark, root, "m", model), range(3)))
    assert sorted(versions) == [2, 3, 4] and registry.latest(spark, root, "m") == 4
    assert all(registry.pull(spark, root, "m", v) is not None for v in versions)
