"""Regression metrics and model choice over prediction tables (AGG-05..08, ML-07, ML-08).

All metrics of all models come out of one aggregate keyed by `model`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.contracts import MAPE_EPSILON, NO_MODEL_SCORE


def r2_expr(label: str = "label", prediction: str = "prediction") -> Column:
    """Coefficient of determination (AGG-05).

    The total sum of squares comes from `var_pop`, which Spark accumulates
    with a centred (stable) update, so large means lose no digits. A constant
    label scores 1 when predicted exactly, else 0.
    """
    y, p = F.col(label), F.col(prediction)
    ss_res = F.sum((y - p) * (y - p))
    ss_tot = F.var_pop(y) * F.count(y)
    return (F.when(ss_tot == 0, F.when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
            .otherwise(F.lit(1.0) - ss_res / ss_tot))


def rmse_expr(label: str = "label", prediction: str = "prediction") -> Column:
    """Root mean squared error (AGG-06)."""
    y, p = F.col(label), F.col(prediction)
    return F.sqrt(F.avg((y - p) * (y - p)))


def mape_expr(label: str = "label", prediction: str = "prediction",
              eps: float = MAPE_EPSILON) -> Column:
    """Mean absolute percentage error with a tiny guard on the divisor (AGG-07)."""
    y, p = F.col(label), F.col(prediction)
    return F.avg(F.abs((y - p) / (y + F.lit(eps)))) * F.lit(100.0)


def evaluate(predictions: DataFrame, by: list[str] | None = None, label: str = "label",
             prediction: str = "prediction") -> DataFrame:
    """R2, RMSE and MAPE per group (ML-07), plus the count of zero labels.

    A zero label makes MAPE explode (only the epsilon protects the division),
    so `zero_labels` is reported beside it.
    """
    aggs = [r2_expr(label, prediction).alias("r2"),
            rmse_expr(label, prediction).alias("rmse"),
            mape_expr(label, prediction).alias("mape"),
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(F.col(label) == 0, 1)).alias("zero_labels")]
    return predictions.groupBy(*(by or [])).agg(*aggs)


def best_model(metrics: DataFrame, name: str = "model", score: str = "r2",
               ordinal: str = "ordinal") -> DataFrame:
    """The model with the highest score (ML-08).

    Strict improvement over a start value of -999: ties go to the earlier
    model (lowest ordinal); NaN or scores at or below -999 never win; with
    no candidate the result is one row of nulls.
    """
    eligible = (F.col(score) > F.lit(NO_MODEL_SCORE)) & ~F.isnan(F.col(score))
    order = F.struct(F.col(score), -F.col(ordinal))
    return metrics.agg(
        F.max_by(F.when(eligible, F.col(name)), F.when(eligible, order)).alias("best_model"),
        F.max(F.when(eligible, F.col(score))).alias("best_r2"),
    )


def latest_version(registry: DataFrame, name: str = "name", version: str = "version") -> DataFrame:
    """Highest version per model, compared as integers ('10' > '9'); none -> null (AGG-08)."""
    return registry.groupBy(name).agg(F.max(F.col(version).try_cast("int")).alias("latest_version"))
