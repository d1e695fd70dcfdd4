"""Weather blocks to hourly rows, city dimension, nested forecast records.

SRC-09: a landed block per city holds start, exclusive end, step (seconds)
and one array per variable; it expands to one row per step, in parallel,
with `posexplode(arrays_zip(...))` (a block is one row, so a year of hourly
values is ~9k elements: no block is ever split across the driver).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.contracts import CITIES, CITY_LOCATION_COLUMNS, CITY_SCHEMA, WEATHER_VARIABLES

REQUEST_ZONE = "Europe/London"     # fixed value: the zone whose days a weather request names


def _steps(time: Column, end: Column, interval: Column) -> Column:
    """Number of steps in [time, end) with the given stride (0 when empty)."""
    span = end - time
    return F.when((interval > 0) & (span > 0),
                  F.floor((span + interval - F.lit(1)) / interval)).otherwise(F.lit(0)).cast("long")


def block_errors(blocks: DataFrame, variables: list[str] = WEATHER_VARIABLES) -> DataFrame:
    """Blocks whose arrays do not hold exactly one value per step."""
    n = _steps(F.col("time"), F.col("time_end"), F.col("interval"))
    bad = [F.when(F.coalesce(F.size(F.col(v)), F.lit(0)) != n, F.lit(v)) for v in variables]
    return (blocks.select("city", n.alias("steps"),
                          F.filter(F.array(*bad), lambda x: x.isNotNull()).alias("bad_variables"))
            .where(F.size("bad_variables") > 0))


def expand_blocks(blocks: DataFrame, variables: list[str] = WEATHER_VARIABLES,
                  keep: list[str] | None = None) -> DataFrame:
    """One row per step: `city`, `date` (UTC timestamp), one column per variable (SRC-09).

    Time of step i is `time + i * interval`; steps at or past `time_end` are
    not produced (end exclusive). Blocks failing `block_errors` produce no rows.
    Missing arrays are read as empty. `keep` lists block columns carried along.
    """
    keep = keep or []
    n = _steps(F.col("time"), F.col("time_end"), F.col("interval"))
    sizes_ok = [F.coalesce(F.size(F.col(v)), F.lit(0)) == n for v in variables]
    ok = sizes_ok[0]
    for s in sizes_ok[1:]:
        ok = ok & s
    arrays = [F.coalesce(F.col(v), F.array().cast(T.ArrayType(T.FloatType()))).alias(v)
              for v in variables]
    zipped = F.arrays_zip(*arrays)
    exploded = (blocks.where(ok)
                .select("city", "time", "interval", *keep, F.posexplode(zipped).alias("pos", "v")))
    return exploded.select(
        "city", *keep,
        F.timestamp_seconds(F.col("time") + F.col("pos") * F.col("interval")).alias("date"),
        *[F.col("v").getField(v).alias(v) for v in variables],
    )


def city_dimension(spark: SparkSession) -> DataFrame:
    """The fixed city table: name, latitude, longitude (SRC-10)."""
    return spark.createDataFrame(CITIES, CITY_SCHEMA)


def attach_dimension(facts: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """Left join facts to a dimension. Whether it is broadcast is the planner's choice, from measured
    bytes (`spark.sql.autoBroadcastJoinThreshold`)."""
    return facts.join(dim, on=on, how="left")


def unmatched(facts: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """Fact keys with no dimension row (reported, not dropped)."""
    return facts.select(on).distinct().join(dim.select(on), on=on, how="left_anti")


# Nested daily forecast record -> flat row (SRC-11).
FORECAST_SCHEMA = T.StructType([
    T.StructField("dt", T.LongType()),
    T.StructField("T", T.StructType([T.StructField("min", T.DoubleType()),
                                     T.StructField("max", T.DoubleType())])),
    T.StructField("humidity", T.StructType([T.StructField("min", T.DoubleType()),
                                            T.StructField("max", T.DoubleType())])),
    T.StructField("precipitation", T.StructType([T.StructField("24h", T.DoubleType())])),
    T.StructField("uv", T.DoubleType()),
    T.StructField("weather12H", T.StructType([T.StructField("icon", T.StringType()),
                                              T.StructField("desc", T.StringType())])),
    T.StructField("sun", T.StructType([T.StructField("rise", T.LongType()),
                                       T.StructField("set", T.LongType())])),
])


def flatten_forecast(df: DataFrame, json_col: str = "forecast", city_col: str = "city",
                     lat_col: str = "latitude", lon_col: str = "longitude",
                     keep: list[str] | None = None) -> DataFrame:
    """JSON forecast text + city + coordinates -> the daily weather row (SRC-11).

    `db_id` = city + '_' + dt. A missing nested object gives nulls. Columns
    in `keep` are carried after the 15 table columns.
    """
    keep = keep or []
    f = F.from_json(F.col(json_col), FORECAST_SCHEMA).alias("f")
    parsed = df.select(F.col(city_col).alias("city"), F.col(lat_col).alias("latitude"),
                       F.col(lon_col).alias("longitude"), f, *keep)
    return parsed.select(
        F.concat_ws("_", F.col("city"), F.col("f.dt").cast("string")).alias("db_id"),
        F.col("f.dt").alias("dt"),
        F.col("f.T.min").cast("float").alias("min_temp"),
        F.col("f.T.max").cast("float").alias("max_temp"),
        F.col("f.humidity.min").try_cast("int").alias("min_humidity"),
        F.col("f.humidity.max").try_cast("int").alias("max_humidity"),
        F.col("f.precipitation.`24h`").cast("float").alias("precipitation"),
        F.col("f.uv").try_cast("int").alias("uv"),
        F.col("f.weather12H.icon").alias("weather_icon"),
        F.col("f.weather12H.desc").alias("weather_desc"),
        F.col("f.sun.rise").alias("sunrise"),
        F.col("f.sun.set").alias("sunset"),
        F.col("latitude").cast("float").alias("latitude"),
        F.col("longitude").cast("float").alias("longitude"),
        F.col("city"),
        *keep,
    )


def json_fields(df: DataFrame, json_col: str, paths: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """Pick fields out of JSON text by path (`$.a.b`); absent -> null."""
    keep = keep or []
    return df.select(*keep, *[F.get_json_object(F.col(json_col), p).alias(n) for n, p in paths.items()])


_CITY_LIST = T.StructType([T.StructField("cities", T.ArrayType(T.StructType([
    T.StructField(name, T.StringType()) for name, _ in CITY_LOCATION_COLUMNS])))])


def explode_cities(df: DataFrame, json_col: str = "value") -> DataFrame:
    """JSON `{"cities": [{...}, ...]}` -> one row per city, ten text columns (SRC-12)."""
    return (df.select(F.from_json(F.col(json_col), _CITY_LIST).alias("j"))
            .select(F.inline(F.col("j.cities"))))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Landed weather blocks: JSON lines, one object per city and request.

    Fields: city, time, time_end, interval and one array per variable
    (`WEATHER_BLOCK_SCHEMA`); the schema is declared, never inferred.
    """
    from wattline.contracts import WEATHER_BLOCK_SCHEMA
    return spark.read.schema(WEATHER_BLOCK_SCHEMA).json(path)


def fetch_weather(spark: SparkSession, blocks_path: str, start_date: str, end_date: str) -> DataFrame:
    """Hourly weather of every city from landed blocks (SRC-09 + SRC-10).

    Keeps the hours of the days `start_date` to `end_date` as the request
    counts them, in `REQUEST_ZONE` (a summer day begins at 23:00 UTC), with
    the city's coordinates attached from the fixed city table. Cities are
    kept as a column (one row per city and hour). A block whose arrays do not
    match its range is an error that names its city, as is a city outside
    the fixed table.
    """
    blocks = read_blocks(spark, blocks_path)
    bad = block_errors(blocks).select("city", "bad_variables").limit(20).collect()
    if bad:
        raise ValueError("weather blocks do not match their range: "
                         + "; ".join(f"{r['city']}: {', '.join(r['bad_variables'])}" for r in bad))
    cities = F.broadcast(city_dimension(spark))    # 21 fixed rows
    unknown = [r["city"] for r in unmatched(blocks, cities, "city").limit(20).collect()]
    if unknown:
        raise ValueError(f"weather of unknown cities: {', '.join(map(str, unknown))}")
    hourly = expand_blocks(blocks)
    start = F.to_utc_timestamp(F.lit(start_date).cast("timestamp_ntz").cast("timestamp"), REQUEST_ZONE)
    stop = F.to_utc_timestamp(F.date_add(F.lit(end_date).cast("date"), 1).cast("timestamp"), REQUEST_ZONE)
    in_range = hourly.where((F.col("date") >= start) & (F.col("date") < stop))
    return attach_dimension(in_range, cities, on="city")
