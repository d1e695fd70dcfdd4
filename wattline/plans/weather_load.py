"""Loads of the weather tables: hourly weather, daily forecasts, city locations.

Every load is insert-if-absent on the table's key; rows that break the
table's contract are set aside with their reasons.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.contracts import CITY_LOCATION_COLUMNS, CITY_LOCATION_SCHEMA, WEATHER_DAILY_SCHEMA
from wattline.operators import tables
from wattline.session import fresh_location
from wattline.sources import weather


def _staged(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Written once and read back, with a row order that later reads agree on."""
    path = fresh_location(spark, "staged-weather")
    df.withColumn("_row_id", F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path)


def load_hourly(spark: SparkSession, blocks_path: str, start_date: str, end_date: str, table_path: str) -> int:
    """Hourly weather per city into the `meteo_data` table (key: city and hour), partitioned by year; rows inserted."""
    hourly = weather.fetch_weather(spark, blocks_path, start_date, end_date)
    batch = _staged(spark, hourly.withColumn("year", F.year("date")))
    names = [f.name for f in batch.schema.fields if f.name != "_row_id"]
    return tables.insert_if_absent(spark, table_path, batch.select(*names, "_row_id"), ["city", "date"], ["_row_id"],
                                   partition_by=["year"], return_inserted=False)


def _load(spark: SparkSession, rows: DataFrame, reasons, schema, key: list[str], table_path: str,
          rejected_path: str) -> dict:
    staged = _staged(spark, rows.withColumn("_reasons", reasons))
    valid = staged.where(F.size("_reasons") == 0).drop("_reasons")
    rejected = staged.where(F.size("_reasons") > 0).select(
        *[F.col(k) for k in key], F.array_join("_reasons", ",").alias("reasons"))
    return {"inserted": tables.insert_if_absent(spark, table_path, valid, key, ["_row_id"], schema=schema,
                                                return_inserted=False),
            "rejected": tables.append_counted(rejected, rejected_path)}


def load_daily(spark: SparkSession, records_path: str, table_path: str, rejected_path: str) -> dict:
    """Daily forecasts (JSON lines: city, latitude, longitude, forecast as JSON text) into their table (key db_id)."""
    schema = "city string, latitude double, longitude double, forecast string"
    rows = weather.flatten_forecast(spark.read.schema(schema).json(records_path))
    required = [f.name for f in WEATHER_DAILY_SCHEMA.fields if not f.nullable]
    return _load(spark, rows, tables.null_violations(required), WEATHER_DAILY_SCHEMA, ["db_id"], table_path, rejected_path)


def load_cities(spark: SparkSession, records_path: str, table_path: str, rejected_path: str) -> dict:
    """City locations (a JSON document holding `cities`) into their table (key: all columns)."""
    rows = weather.explode_cities(spark.read.text(records_path, wholetext=True))
    limits = [(name, size) for name, size in CITY_LOCATION_COLUMNS if size]
    return _load(spark, rows, tables.length_violations(limits), CITY_LOCATION_SCHEMA,
                 [name for name, _ in CITY_LOCATION_COLUMNS], table_path, rejected_path)
