"""The three regressors, fitted and applied as Spark ML stages (ML-02, 03, 05, 06).

Least squares and the forest are `PipelineModel`s (assembler + estimator);
k-NN keeps its training table (checkpointed to the shared folder) and
predicts with the blocked exact search of `wattline.ml.knn`.
"""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.contracts import FOREST_SEED, FOREST_TREES, NEIGHBOURS, TARGET
from wattline.ml.knn import knn_predict
from wattline.session import shared_root

MODEL_ORDER = ["LinearRegression", "RandomForest", "KNN"]


def assembler(features: list[str]) -> VectorAssembler:
    """Feature columns -> one vector column (PRJ-12)."""
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")


def linear_regression(features: list[str], label: str = TARGET) -> Pipeline:
    """Ordinary least squares with intercept: no penalty, normal equations."""
    lr = LinearRegression(featuresCol="features", labelCol=label, regParam=0.0,
                          elasticNetParam=0.0, solver="normal", fitIntercept=True)
    return Pipeline(stages=[assembler(features), lr])


def random_forest(features: list[str], label: str = TARGET, trees: int = FOREST_TREES,
                  seed: int = FOREST_SEED, max_depth: int = 30, max_bins: int = 128,
                  max_memory_mb: int = 2048) -> Pipeline:
    """Random forest: every feature considered at each split, bootstrap rows.

    Spark bins split candidates and caps depth at 30, so the trees are not
    bit-identical to fully grown ones; quality is checked by metric range.
    A larger node-statistics budget and cached node ids let each pass over
    the data grow more nodes: fewer passes for 200 deep trees (the training
    frame is one row per hour, so this memory does not grow with raw volume).
    """
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees, seed=seed,
                               featureSubsetStrategy="all", maxDepth=max_depth, maxBins=max_bins,
                               subsamplingRate=1.0, bootstrap=True, maxMemoryInMB=max_memory_mb,
                               cacheNodeIds=True, checkpointInterval=10)
    return Pipeline(stages=[assembler(features), rf])


class KNNModel:
    """Exact k-NN regressor: the training table plus (features, label, k)."""

    def __init__(self, train: DataFrame, features: list[str], label: str = TARGET,
                 k: int = NEIGHBOURS, id_col: str = "row_id"):
        self.train, self.features, self.label, self.k, self.id_col = train, features, label, k, id_col

    def transform(self, df: DataFrame) -> DataFrame:
        pred = knn_predict(self.train, df, self.features, self.label, self.id_col, self.k)
        return df.join(pred, on=self.id_col, how="left")

    def save(self, path: str) -> None:
        spark = self.train.sparkSession
        self.train.write.mode("overwrite").parquet(f"{path}/train")
        meta = json.dumps({"features": self.features, "label": self.label, "k": self.k,
                           "id_col": self.id_col})
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> KNNModel:
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
        return cls(spark.read.parquet(f"{path}/train"), meta["features"], meta["label"],
                   meta["k"], meta["id_col"])


def train_models(train: DataFrame, features: list[str], label: str = TARGET,
                 id_col: str = "row_id", forest_depth: int = 30) -> dict:
    """Fit all three models on the same training frame (ML-05).

    The frame is checkpointed once (shared folder), so the three fits and
    the k-NN table read the same fixed rows.
    """
    shared_root(train.sparkSession)
    fixed = train.checkpoint(eager=True)
    return {
        "LinearRegression": linear_regression(features, label).fit(fixed),
        "RandomForest": random_forest(features, label, max_depth=forest_depth).fit(fixed),
        "KNN": KNNModel(fixed.select(id_col, *features, label), features, label, NEIGHBOURS, id_col),
    }


def predict(model, df: DataFrame, id_col: str = "row_id", label: str = TARGET) -> DataFrame:
    """Batch prediction (ML-06): `id_col`, `label`, `prediction`."""
    out = model.transform(df)
    return out.select(id_col, F.col(label).alias("label"), F.col("prediction").cast("double"))


def save_model(model, path: str) -> str:
    """Persist a fitted model (ML-09); returns its kind for the registry."""
    if isinstance(model, KNNModel):
        model.save(path)
        return "knn"
    model.write().overwrite().save(path)
    return "pipeline"


def load_model(spark: SparkSession, path: str, kind: str):
    if kind == "knn":
        return KNNModel.load(spark, path)
    return PipelineModel.load(path)
