"""Contiguous run of available years (SRC-08)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def contiguous_years(years: DataFrame, start_year: int, col: str = "year") -> DataFrame:
    """Years from `start_year` upward, stopping before the first missing year.

    `years` may hold duplicates and years before the start. A year belongs to
    the run when it equals start + (its rank - 1) among the distinct years at
    or after the start. The window runs over distinct years only (a few
    dozen rows), so its single partition stays tiny.
    """
    distinct = years.select(F.col(col).cast("int").alias("year")).where(F.col("year") >= start_year).distinct()
    w = Window.orderBy("year")
    ranked = distinct.withColumn("_rank", F.row_number().over(w))
    return ranked.where(F.col("year") - F.col("_rank") == F.lit(start_year - 1)).select("year")
