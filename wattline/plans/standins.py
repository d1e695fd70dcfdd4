"""Driver tables shaped as the pipeline's inputs.

The test tables are TPC-H-like, not electricity files, so each registered
query first reshapes one of them into the form its operator expects. Every
stand-in is defined twice, side by side: once as DataFrame code and once as a
DuckDB SQL fragment for the oracle. All cells derive from table values (no
row subsets), so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# Half-hourly readings from `events` (all cells text, as a loaded file gives)
#
#   perimetre    'zone_<user_id>'
#   nature       event_type
#   date         'yyyy-MM-dd'; 'dd/MM/yyyy' for views; month 13 when value < 0.5
#   heures       'HH:mm'
#   consommation value in hundredths as integer text; 'ND' for errors
#   source_file  'events_<yyyy-MM>.xls'
#   _row_order   event_id (row order inside the file)
# ---------------------------------------------------------------------------


def _reading_cells() -> dict:
    ts = F.col("ts")
    date = (F.when(F.col("value") < 0.5, F.date_format(ts, "yyyy-13-dd"))
            .when(F.col("event_type") == "view", F.date_format(ts, "dd/MM/yyyy"))
            .otherwise(F.date_format(ts, "yyyy-MM-dd")))
    cons = (F.when(F.col("event_type") == "error", F.lit("ND"))
            .otherwise(F.round(F.col("value") * 100).cast("bigint").cast("string")))
    return {
        "perimetre": F.concat(F.lit("zone_"), F.col("user_id").cast("string")),
        "nature": F.col("event_type"),
        "date": date,
        "heures": F.date_format(ts, "HH:mm"),
        "consommation": cons,
        "source_file": F.concat(F.lit("events_"), F.date_format(ts, "yyyy-MM"), F.lit(".xls")),
        "_row_order": F.col("event_id"),
    }


def readings(events: DataFrame) -> DataFrame:
    return events.select(*[e.alias(n) for n, e in _reading_cells().items()])


READINGS_SQL = """
  SELECT 'zone_' || CAST(user_id AS VARCHAR) AS perimetre,
         event_type AS nature,
         CASE WHEN value < 0.5 THEN strftime(ts, '%Y-13-%d')
              WHEN event_type = 'view' THEN strftime(ts, '%d/%m/%Y')
              ELSE strftime(ts, '%Y-%m-%d') END AS date,
         strftime(ts, '%H:%M') AS heures,
         CASE WHEN event_type = 'error' THEN 'ND'
              ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END AS consommation,
         'events_' || strftime(ts, '%Y-%m') || '.xls' AS source_file,
         event_id AS _row_order
  FROM events"""

# Readings as wide as a real file: 35 more columns of numbers as text, some missing, some not numbers.
WIDE = [f"c_{j}" for j in range(1, 36)]


def wide_readings(events: DataFrame) -> DataFrame:
    def cell(j: int):
        i = F.col("event_id")
        return (F.when((i + j) % 7 == 0, F.lit("ND")).when((i * j) % 11 == 0, F.lit(None))
                .when((i + j) % 13 == 0, F.lit("n/d"))
                .otherwise((F.round(F.col("value") * 100).cast("bigint") + j * F.col("user_id")).cast("string")))

    return events.select(*[e.alias(n) for n, e in _reading_cells().items()],
                         *[cell(j).alias(c) for j, c in enumerate(WIDE, 1)])


_WIDE_CELLS = ", ".join(
    f"CASE WHEN (event_id + {j}) % 7 = 0 THEN 'ND' WHEN (event_id * {j}) % 11 = 0 THEN NULL WHEN (event_id + {j}) % 13 = 0 "
    f"THEN 'n/d' ELSE CAST(CAST(round(value * 100) AS BIGINT) + {j} * user_id AS VARCHAR) END AS {c}"
    for j, c in enumerate(WIDE, 1))

# Readings after the sentinel step and timestamp parsing (DuckDB).
PARSED_SQL = f"""
  SELECT NULLIF(perimetre, 'ND') AS perimetre, NULLIF(nature, 'ND') AS nature,
         NULLIF(date, 'ND') AS date, NULLIF(heures, 'ND') AS heures,
         NULLIF(consommation, 'ND') AS consommation, NULLIF(source_file, 'ND') AS source_file,
         _row_order,
         try_strptime(NULLIF(date, 'ND') || ' ' || NULLIF(heures, 'ND'),
                      ['%Y-%m-%d %H:%M', '%Y-%m-%d %H:%M:%S', '%d/%m/%Y %H:%M', '%d/%m/%Y %H:%M:%S'])
           AS datetime
  FROM ({READINGS_SQL}) r"""


WIDE_HOURLY_SQL = f"""
  SELECT CAST(date_trunc('hour', datetime) AS TIMESTAMP) AS datetime,
         {", ".join(f"first({c} ORDER BY datetime, _row_order) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ["consommation", *WIDE])}
  FROM (SELECT p.*, {", ".join(f"NULLIF(e.{c}, 'ND') AS {c}" for c in WIDE)} FROM ({PARSED_SQL}) p
        JOIN (SELECT event_id, {_WIDE_CELLS} FROM events) e ON e.event_id = p._row_order) w
  WHERE datetime IS NOT NULL
  GROUP BY date_trunc('hour', datetime)"""


def number_sql(expr: str) -> str:
    """DuckDB twin of `wattline.functions.numeric.to_number`."""
    return (f"CASE WHEN regexp_matches(trim({expr}), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') "
            f"OR regexp_matches(trim({expr}), '^[+-]?(inf|infinity)$', 'i') "
            f"THEN TRY_CAST(trim({expr}) AS DOUBLE) END")


def first_sql(col: str) -> str:
    return (f"first({col} ORDER BY datetime, _row_order) FILTER (WHERE {col} IS NOT NULL) AS {col}")


HOURLY_SQL = f"""
  SELECT CAST(date_trunc('hour', datetime) AS TIMESTAMP) AS datetime,
         {first_sql('consommation')}, {first_sql('date')}, {first_sql('heures')},
         {first_sql('nature')}, {first_sql('perimetre')}, {first_sql('source_file')}
  FROM ({PARSED_SQL}) p
  WHERE datetime IS NOT NULL
  GROUP BY date_trunc('hour', datetime)"""


def calendar_sql(ts: str) -> str:
    return (f"CAST(hour({ts}) AS INTEGER) AS \"hour\", CAST(day({ts}) AS INTEGER) AS \"day\", "
            f"CAST(month({ts}) AS INTEGER) AS \"month\", CAST(isodow({ts}) - 1 AS INTEGER) AS dayofweek, "
            f"CAST(CASE WHEN isodow({ts}) - 1 IN (5, 6) THEN 1 ELSE 0 END AS INTEGER) AS weekend")


# ---------------------------------------------------------------------------
# Consumption-table rows from `events` (typed; key has in-batch repeats)
#
#   périmètre    'user_<user_id>'     nature   event_type
#   date         'yyyy-MM-dd'         heures   'HH:00'
#   consommation value in hundredths (int)    event_id  row order
# "Stored" rows are the view and click events.
# ---------------------------------------------------------------------------

CONSUMPTION_KEY = ["périmètre", "date", "heures"]


def consumption_rows(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("périmètre"),
        F.col("event_type").alias("nature"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.date_format("ts", "HH:00").alias("heures"),
        F.round(F.col("value") * 100).cast("int").alias("consommation"),
        F.col("event_id"),
    )


def stored_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("nature").isin("view", "click"))


CONSUMPTION_SQL = """
  SELECT 'user_' || CAST(user_id AS VARCHAR) AS "périmètre", event_type AS nature,
         strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H:00') AS heures,
         CAST(round(value * 100) AS INTEGER) AS consommation, event_id
  FROM events"""

STORED_SQL = f"SELECT * FROM ({CONSUMPTION_SQL}) c WHERE nature IN ('view', 'click')"


def first_per_key_sql(rel: str, key: list[str], order: str, cols: str = "*") -> str:
    k = ", ".join(f'"{c}"' for c in key)
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {order}) AS _rn "
            f"FROM ({rel}) x) y WHERE _rn = 1")


def not_exists_sql(rel: str, stored: str, key: list[str]) -> str:
    cond = " AND ".join(f'i."{c}" IS NOT DISTINCT FROM s."{c}"' for c in key)
    return f"SELECT i.* FROM ({rel}) i WHERE NOT EXISTS (SELECT 1 FROM ({stored}) s WHERE {cond})"


def int64_sql(expr: str) -> str:
    """DuckDB twin of `wattline.functions.numeric.to_int64`."""
    num = number_sql(expr)
    return (f"CASE WHEN regexp_matches(trim({expr}), '^[+-]?[0-9]+$') THEN TRY_CAST(trim({expr}) AS BIGINT) "
            f"WHEN ({num}) = floor({num}) AND abs({num}) < 9.2233720368547758e18 "
            f"THEN CAST({num} AS BIGINT) END")


# ---------------------------------------------------------------------------
# Weather blocks from `embeddings`: one block per vector, hourly from
# 2020-01-01 UTC, one value per element.
# ---------------------------------------------------------------------------

WEATHER_START = 1577836800  # 2020-01-01 00:00:00 UTC


def weather_blocks(emb: DataFrame) -> DataFrame:
    e = F.col("embedding")
    return emb.select(
        F.concat(F.lit("vec_"), F.col("vec_id").cast("string")).alias("city"),
        F.lit(WEATHER_START).cast("long").alias("time"),
        (F.lit(WEATHER_START) + F.size(e) * 3600).cast("long").alias("time_end"),
        F.lit(3600).alias("interval"),
        e.alias("temperature_2m"),
        F.reverse(e).alias("relative_humidity_2m"),
        F.transform(e, lambda x: F.abs(x)).alias("snowfall"),
        F.transform(e, lambda x: x * F.lit(2.0).cast("float")).alias("precipitation"),
        F.transform(e, lambda x: -x).alias("weather_code"),
    )


WEATHER_HOURLY_SQL = f"""
  SELECT 'vec_' || CAST(vec_id AS VARCHAR) AS city,
         make_timestamp(CAST({WEATHER_START} + (i - 1) * 3600 AS BIGINT) * 1000000) AS date,
         embedding[i] AS temperature_2m,
         list_reverse(embedding)[i] AS relative_humidity_2m,
         abs(embedding[i]) AS snowfall,
         embedding[i] * CAST(2.0 AS FLOAT) AS precipitation,
         -embedding[i] AS weather_code
  FROM embeddings, range(1, len(embedding) + 1) r(i)"""
