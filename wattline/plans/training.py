"""The training run: readings -> hourly features -> split -> fit three
regressors -> score on the test share -> keep and register the best.

Everything up to the fits is one lazy plan with a single exchange (on the
hour). The hourly feature table is small whatever the raw volume (one row
per hour), so the fits run on a compact, checkpointed frame.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.contracts import TARGET
from wattline.ml import metrics as M
from wattline.ml import registry
from wattline.ml.models import MODEL_ORDER, predict, train_models
from wattline.ml.split import test_flag
from wattline.operators.hourly import feature_table
from wattline.session import shared_root

READING_ZONE = "Europe/Paris"      # fixed value: the zone of the readings' wall clock


def local_weather(weather: DataFrame) -> DataFrame:
    """Hourly weather (UTC `date`, as `fetch_weather` gives) by the hour of the readings' wall clock."""
    local = F.from_utc_timestamp(F.col("date"), READING_ZONE)
    return weather.withColumn("hour_ts", F.date_trunc("hour", local).cast("timestamp_ntz")).drop("date")


def hourly_training_rows(readings: DataFrame, order_cols: list[str] | None = None,
                         numeric: str = "auto", weather: DataFrame | None = None) -> DataFrame:
    """The feature table plus `row_id` (epoch hour) and the split flag `is_test`.

    With `weather`, each hour also gets the weather variables averaged over cities.
    """
    row_id = F.unix_seconds(F.col("hour_ts").cast("timestamp"))
    rows = feature_table(readings, order_cols, numeric, None if weather is None else local_weather(weather),
                         keep={"row_id": row_id, "is_test": test_flag(row_id)})
    feats = [c for c in rows.columns if c not in ("row_id", "is_test", TARGET)]
    return rows.select("row_id", "is_test", TARGET, *feats)


def write_features(readings: DataFrame, path: str, weather: DataFrame | None = None,
                   order_cols: list[str] | None = None) -> None:
    """The feature table (`final_features` with weather), written partitioned by year."""
    table = feature_table(readings, order_cols, weather=None if weather is None else local_weather(weather),
                          keep={"year": F.year("hour_ts")})
    table.write.mode("overwrite").partitionBy("year").parquet(path)


@dataclass
class TrainingResult:
    metrics: DataFrame
    best: str | None
    best_r2: float | None
    models: dict
    version: int | None


def run_training(spark: SparkSession, readings: DataFrame, order_cols: list[str] | None = None,
                 registry_root: str | None = None, model_name: str = "load_model",
                 forest_depth: int = 30, weather: DataFrame | None = None) -> TrainingResult:
    shared_root(spark)  # lineage cuts go to the shared spark.checkpoint.dir
    rows = hourly_training_rows(readings, order_cols, weather=weather).checkpoint(eager=True)
    feats = [c for c in rows.columns if c not in ("row_id", "is_test", TARGET)]
    train = rows.where(~F.col("is_test"))
    test = rows.where(F.col("is_test"))
    models = train_models(train, feats, TARGET, id_col="row_id", forest_depth=forest_depth)
    preds = None
    for i, name in enumerate(MODEL_ORDER):
        p = predict(models[name], test, id_col="row_id").select(
            F.lit(name).alias("model"), F.lit(i).alias("ordinal"), "label", "prediction")
        preds = p if preds is None else preds.unionByName(p)
    metrics = M.evaluate(preds, by=["model", "ordinal"]).checkpoint(eager=True)
    best_row = M.best_model(metrics).first()
    version = None
    if registry_root and best_row["best_model"] is not None:
        version = registry.push(spark, registry_root, model_name, models[best_row["best_model"]])
    return TrainingResult(metrics, best_row["best_model"], best_row["best_r2"], models, version)
