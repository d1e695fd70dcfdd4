"""Registered queries: one per inventory row a driver table can feed.

`QUERIES[name](spark, sf_dir) -> DataFrame` and, where the operator is
expressible in SQL, `ORACLE[name]` is the DuckDB twin over the same tables.
Column names and types match between the two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.contracts import CONSUMPTION_COLUMNS
from wattline.functions.numeric import to_int64, to_number
from wattline.functions.timefmt import calendar_columns, floor_hour, reading_timestamp
from wattline.ml import metrics as M
from wattline.ml.knn import knn_predict
from wattline.ml.split import split_sql, test_flag
from wattline.operators import clean, hourly, profile, tables
from wattline.plans import standins as S
from wattline.session import fresh_location
from wattline.sources import weather, years

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _readings(spark, sf_dir):
    return S.readings(S.table(spark, sf_dir, "events"))


# ---------------------------------------------------------------------------
# AGG-10 flagship: readings -> hourly features with a numeric target
# ---------------------------------------------------------------------------

@register("agg_10", f"""
SELECT COALESCE({S.number_sql('consommation')}, 0.0) AS consommation, {S.calendar_sql('datetime')}
FROM ({S.HOURLY_SQL}) h
""")
def agg_10(spark, sf_dir):
    return hourly.feature_table(_readings(spark, sf_dir), order_cols=["_row_order"])


@register("agg_10_wide", f"""
SELECT {", ".join(f"COALESCE({S.number_sql(c)}, 0.0) AS {c}" for c in ["consommation", *S.WIDE])}, {S.calendar_sql('datetime')}
FROM ({S.WIDE_HOURLY_SQL}) h
""")
def agg_10_wide(spark, sf_dir):
    return hourly.feature_table(S.wide_readings(S.table(spark, sf_dir, "events")), order_cols=["_row_order"])


@register("agg_03", f"SELECT * FROM ({S.HOURLY_SQL}) h")
def agg_03(spark, sf_dir):
    return hourly.aggregate_hourly(_readings(spark, sf_dir), order_cols=["_row_order"])


@register("agg_02", f"""
SELECT datetime, consommation, nature FROM ({S.HOURLY_SQL}) h
""")
def agg_02(spark, sf_dir):
    prepared = clean.with_reading_time(clean.sentinel_to_null(
        _readings(spark, sf_dir).select("date", "heures", "consommation", "nature", "_row_order")))
    return hourly.hourly_aggregate(prepared.drop("date", "heures"), order_cols=["_row_order"], known_time=True)


@register("agg_01", """
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS datetime, round(avg(value), 6) AS consommation
FROM events GROUP BY date_trunc('hour', ts)
""")
def agg_01(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events")
    prepared = ev.select(F.col("value").alias("consommation"), F.col("ts").alias("datetime"),
                         floor_hour(F.col("ts")).alias("hour_ts"), F.col("user_id"))
    out = hourly.hourly_aggregate(prepared, order_cols=[])
    return out.select("datetime", F.round("consommation", 6).alias("consommation"))


@register("prj_08", f"""
SELECT event_id, {S.calendar_sql('ts')} FROM events
""")
def prj_08(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events")
    cal = calendar_columns(F.col("ts"))
    return ev.select("event_id", *[v.alias(k) for k, v in cal.items()])


# ---------------------------------------------------------------------------
# Projections (PRJ-*)
# ---------------------------------------------------------------------------

_CUST = "customer"
_PAD_NAMES = ["key", "name", "nation", "balance", "segment", "extra_1", "extra_2"]


@register("prj_02_pad", """
SELECT c_custkey AS "key", c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
       c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS extra_1, CAST(NULL AS VARCHAR) AS extra_2
FROM customer
""")
def prj_02_pad(spark, sf_dir):
    return clean.conform_positional(S.table(spark, sf_dir, _CUST), _PAD_NAMES)


@register("prj_02_cut", """
SELECT c_custkey AS "key", c_name AS name, c_nationkey AS nation FROM customer
""")
def prj_02_cut(spark, sf_dir):
    return clean.conform_positional(S.table(spark, sf_dir, _CUST), _PAD_NAMES[:3])


def _customer_text(c):
    """Customer numbers spelled as text, some spellings a strict reader rejects."""
    return c.select(
        F.col("c_name"),
        F.col("c_custkey").cast("string").alias("custkey"),
        F.when(F.col("c_acctbal") < 0, F.concat(F.col("c_nationkey").cast("string"), F.lit("d")))
         .otherwise(F.concat(F.lit(" "), F.col("c_nationkey").cast("string"), F.lit(" "))).alias("nation"),
        F.col("c_acctbal").cast("string").alias("balance"),
        F.floor("c_acctbal").cast("double").cast("string").alias("balance_whole"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit("e2")).alias("nation_e2"),
    )


_CUSTOMER_TEXT_SQL = """
  SELECT c_name, CAST(c_custkey AS VARCHAR) AS custkey,
         CASE WHEN c_acctbal < 0 THEN CAST(c_nationkey AS VARCHAR) || 'd'
              ELSE ' ' || CAST(c_nationkey AS VARCHAR) || ' ' END AS nation,
         CAST(c_acctbal AS VARCHAR) AS balance,
         CAST(CAST(floor(c_acctbal) AS DOUBLE) AS VARCHAR) AS balance_whole,
         CAST(c_nationkey AS VARCHAR) || 'e2' AS nation_e2
  FROM customer"""


@register("prj_04", f"""
SELECT c_name, {S.int64_sql('custkey')} AS custkey, {S.int64_sql('nation')} AS nation,
       {S.int64_sql('balance')} AS balance, {S.int64_sql('balance_whole')} AS balance_whole,
       {S.int64_sql('nation_e2')} AS nation_e2
FROM ({_CUSTOMER_TEXT_SQL}) t
""")
def prj_04(spark, sf_dir):
    return clean.cast_columns(_customer_text(S.table(spark, sf_dir, _CUST)), ["c_name"])


@register("prj_05", """
SELECT NULLIF(perimetre, 'ND') AS perimetre, NULLIF(nature, 'ND') AS nature, NULLIF(date, 'ND') AS date,
       NULLIF(heures, 'ND') AS heures, NULLIF(consommation, 'ND') AS consommation,
       NULLIF(source_file, 'ND') AS source_file, _row_order
FROM (""" + S.READINGS_SQL + ") r")
def prj_05(spark, sf_dir):
    return clean.sentinel_to_null(_readings(spark, sf_dir))


@register("prj_06", f"SELECT _row_order, CAST(datetime AS TIMESTAMP) AS datetime FROM ({S.PARSED_SQL}) p")
def prj_06(spark, sf_dir):
    r = clean.sentinel_to_null(_readings(spark, sf_dir))
    return r.select("_row_order", reading_timestamp(F.col("date"), F.col("heures")).alias("datetime"))


@register("prj_07", f"""
SELECT _row_order, CAST(date_trunc('hour', datetime) AS TIMESTAMP) AS hour_ts FROM ({S.PARSED_SQL}) p
""")
def prj_07(spark, sf_dir):
    r = clean.with_reading_time(clean.sentinel_to_null(_readings(spark, sf_dir)))
    return r.select("_row_order", "hour_ts")


@register("prj_09", f"SELECT consommation, _row_order FROM ({S.READINGS_SQL}) r")
def prj_09(spark, sf_dir):
    return clean.drop_identifiers(_readings(spark, sf_dir))


@register("prj_10", f"""
SELECT _row_order, COALESCE(consommation, '0') AS consommation, COALESCE(date, '0') AS date,
       COALESCE({S.number_sql('consommation')}, 0.0) AS reading
FROM ({S.PARSED_SQL}) p
""")
def prj_10(spark, sf_dir):
    r = clean.sentinel_to_null(_readings(spark, sf_dir))
    return clean.fill_zero(r.select("_row_order", "consommation", "date",
                                    to_number(F.col("consommation")).alias("reading")))


def _spelled(ev):
    cents = F.round(F.col("value") * 100).cast("bigint").cast("string")
    t = F.col("event_type")
    return (F.when(t == "click", F.concat(cents, F.lit("d")))
            .when(t == "view", F.concat(F.lit(" "), cents, F.lit(" ")))
            .when(t == "purchase", F.concat(cents, F.lit("e1")))
            .when(t == "signup", F.concat(F.lit("."), cents))
            .otherwise(F.lit("nan")))


_SPELLED_SQL = """CASE event_type
    WHEN 'click' THEN CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) || 'd'
    WHEN 'view' THEN ' ' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) || ' '
    WHEN 'purchase' THEN CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) || 'e1'
    WHEN 'signup' THEN '.' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR)
    ELSE 'nan' END"""


@register("prj_11", f"""
SELECT event_id, {S.number_sql('s')} AS consommation FROM (SELECT event_id, {_SPELLED_SQL} AS s FROM events) t
""")
def prj_11(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events")
    return ev.select("event_id", to_number(_spelled(ev)).alias("consommation"))


@register("prj_13", f"""
SELECT event_id, "périmètre" || '_' || date || '_' || heures AS db_id FROM ({S.CONSUMPTION_SQL}) c
""")
def prj_13(spark, sf_dir):
    rows = S.consumption_rows(S.table(spark, sf_dir, "events"))
    return rows.select("event_id", clean.row_key(*S.CONSUMPTION_KEY).alias("db_id"))


@register("prj_14", """
SELECT event_id, CASE WHEN value < 1 THEN NULL ELSE value END AS value FROM events
""")
def prj_14(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events")
    with_nan = ev.select("event_id", F.when(F.col("value") < 1, F.lit(float("nan")))
                         .otherwise(F.col("value")).alias("value"))
    return clean.nan_to_null_all(with_nan)


# ---------------------------------------------------------------------------
# Filters (FLT-*)
# ---------------------------------------------------------------------------

def _stored_consumption(spark, sf_dir, *first):
    """The consumption rows as a stored table: look-ups push their keys to its scan."""
    path = fresh_location(spark, "consumption")
    S.consumption_rows(S.table(spark, sf_dir, "events")).select(*first, "*").write.parquet(path)
    return spark.read.parquet(path)


@register("flt_01", f"""
SELECT * FROM ({S.CONSUMPTION_SQL}) c
WHERE "périmètre" = 'user_8' AND date = '2024-01-01' AND heures = '00:00'
""")
def flt_01(spark, sf_dir):
    return tables.lookup(_stored_consumption(spark, sf_dir), **{"périmètre": "user_8", "date": "2024-01-01", "heures": "00:00"})


@register("flt_02", f"""
SELECT * FROM (SELECT "périmètre" || '_' || date || '_' || heures AS db_id, * FROM ({S.CONSUMPTION_SQL}) c) k
WHERE db_id = 'user_8_2024-01-01_00:00'
""")
def flt_02(spark, sf_dir):
    stored = _stored_consumption(spark, sf_dir, clean.row_key(*S.CONSUMPTION_KEY).alias("db_id"))
    return tables.lookup(stored, db_id="user_8_2024-01-01_00:00")


@register("flt_03", f"""
SELECT _row_order, CAST(date_trunc('hour', datetime) AS TIMESTAMP) AS hour_ts
FROM ({S.PARSED_SQL}) p WHERE datetime IS NOT NULL
""")
def flt_03(spark, sf_dir):
    r = clean.with_reading_time(clean.sentinel_to_null(_readings(spark, sf_dir)))
    return clean.valid_time(r).select("_row_order", "hour_ts")


# ---------------------------------------------------------------------------
# Joins and set operations (JON-*, SET-01)
# ---------------------------------------------------------------------------

@register("jon_01", S.not_exists_sql(S.CONSUMPTION_SQL, S.STORED_SQL, S.CONSUMPTION_KEY))
def jon_01(spark, sf_dir):
    rows = S.consumption_rows(S.table(spark, sf_dir, "events"))
    return tables.not_existing(rows, S.stored_rows(rows), S.CONSUMPTION_KEY)


@register("jon_02", """
SELECT c.hour_ts, round(c.consommation, 6) AS consommation,
       round(w.temperature_2m, 6) AS temperature_2m, round(w.relative_humidity_2m, 6) AS relative_humidity_2m
FROM (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_ts, avg(value) AS consommation
      FROM events GROUP BY 1) c
LEFT JOIN (
  SELECT hour_ts, avg(temperature_2m) AS temperature_2m, avg(relative_humidity_2m) AS relative_humidity_2m
  FROM (SELECT event_type AS city, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_ts,
               avg(value) AS temperature_2m, max(CAST(user_id AS DOUBLE)) AS relative_humidity_2m
        FROM events WHERE event_type <> 'error' GROUP BY 1, 2) per_city
  GROUP BY hour_ts) w
ON c.hour_ts = w.hour_ts
""")
def jon_02(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events")
    hour = floor_hour(F.col("ts")).alias("hour_ts")
    conso = ev.groupBy(hour).agg(F.avg("value").alias("consommation"))
    # hourly weather per city (city = event type, errors carry no weather)
    wx = (ev.where(F.col("event_type") != "error")
          .groupBy(F.col("event_type").alias("city"), floor_hour(F.col("ts")).alias("hour_ts"))
          .agg(F.avg("value").alias("temperature_2m"),
               F.max(F.col("user_id").cast("double")).alias("relative_humidity_2m")))
    out = tables.join_hourly(conso, wx)
    return out.select("hour_ts", *[F.round(c, 6).alias(c) for c in
                                   ["consommation", "temperature_2m", "relative_humidity_2m"]])


@register("set_01", """
SELECT c_custkey AS "key", c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment
FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS "key", s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier
""")
def set_01(spark, sf_dir):
    c = S.table(spark, sf_dir, "customer").toDF("key", "name", "nationkey", "acctbal", "segment")
    s = S.table(spark, sf_dir, "supplier").toDF("key", "name", "nationkey", "acctbal")
    return tables.union_by_name([c, s])


# ---------------------------------------------------------------------------
# Sources (SRC-08..11) over driver tables
# ---------------------------------------------------------------------------

@register("src_08", """
SELECT y AS "year" FROM (
  SELECT y, row_number() OVER (ORDER BY y) AS rk
  FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE year(o_orderdate) >= 1995) d) r
WHERE y - rk = 1994
""")
def src_08(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders")
    return years.contiguous_years(o.select(F.year("o_orderdate").alias("year")), 1995)


@register("src_09", S.WEATHER_HOURLY_SQL)
def src_09(spark, sf_dir):
    blocks = S.weather_blocks(S.table(spark, sf_dir, "embeddings"))
    out = weather.expand_blocks(blocks)
    return out.withColumn("date", F.col("date").cast("timestamp_ntz"))


@register("src_10", """
SELECT c.c_custkey, c.c_nationkey, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def src_10(spark, sf_dir):
    c = S.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = S.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return weather.attach_dimension(c, n, on="c_nationkey")


@register("src_11", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
""")
def src_11(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events")
    out = weather.json_fields(ev, "props", {"k": "$.k"}, keep=["event_id"])
    return out.withColumn("k", F.col("k").cast("bigint"))


# ---------------------------------------------------------------------------
# Aggregations (AGG-04..09)
# ---------------------------------------------------------------------------

_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _agg04_sql() -> str:
    parts = []
    for i, c in enumerate(_LI_COLS):
        num = S.number_sql(f"CAST({c} AS VARCHAR)")
        parts.append(
            f"SELECT '{c}' AS column_name, {i} AS position, "
            f"CASE WHEN count({num}) = 0 THEN 'TEXT' "
            f"WHEN bool_and(({num}) = floor({num}) AND NOT isinf({num})) FILTER (WHERE ({num}) IS NOT NULL) "
            f"THEN 'INTEGER' ELSE 'FLOAT' END AS suggested_type FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@register("agg_04", _agg04_sql())
def agg_04(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem")
    as_text = li.select(*[F.col(c).cast("string").alias(c) for c in _LI_COLS])
    return profile.suggest_types(as_text)


_PRED_SQL = "SELECT o_orderkey, o_totalprice AS label, 0.9 * o_totalprice + 1000 AS prediction FROM orders"


def _orders_pred(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.col("o_totalprice").alias("label"),
                    (F.lit(0.9) * F.col("o_totalprice") + F.lit(1000)).alias("prediction"))


_R2_SQL = ("CASE WHEN var_pop(label) * count(label) = 0 THEN CASE WHEN sum((label - prediction) * (label - prediction)) = 0 "
           "THEN 1.0 ELSE 0.0 END ELSE 1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(label)) END")
_RMSE_SQL = "sqrt(avg((label - prediction) * (label - prediction)))"
_MAPE_SQL = "avg(abs((label - prediction) / (label + 1e-9))) * 100"


@register("agg_05", f"SELECT round({_R2_SQL}, 8) AS r2 FROM ({_PRED_SQL}) p")
def agg_05(spark, sf_dir):
    return _orders_pred(spark, sf_dir).agg(F.round(M.r2_expr(), 8).alias("r2"))


@register("agg_06", f"SELECT round({_RMSE_SQL}, 4) AS rmse FROM ({_PRED_SQL}) p")
def agg_06(spark, sf_dir):
    return _orders_pred(spark, sf_dir).agg(F.round(M.rmse_expr(), 4).alias("rmse"))


@register("agg_07", f"SELECT round({_MAPE_SQL}, 6) AS mape FROM ({_PRED_SQL}) p")
def agg_07(spark, sf_dir):
    return _orders_pred(spark, sf_dir).agg(F.round(M.mape_expr(), 6).alias("mape"))


@register("agg_08", """
SELECT o_orderpriority AS name, max(TRY_CAST(CAST(year(o_orderdate) - 1990 AS VARCHAR) AS INTEGER)) AS latest_version
FROM orders GROUP BY o_orderpriority
""")
def agg_08(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders")
    reg = o.select(F.col("o_orderpriority").alias("name"),
                   (F.year("o_orderdate") - 1990).cast("string").alias("version"))
    return M.latest_version(reg)


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _agg09_sql() -> str:
    parts = []
    for i, a in enumerate(_CORR_COLS):
        for b in _CORR_COLS[i + 1:]:
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS r FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@register("agg_09", _agg09_sql())
def agg_09(spark, sf_dir):
    out = profile.correlations(S.table(spark, sf_dir, "lineitem"), _CORR_COLS)
    return out.withColumn("r", F.round("r", 8))


# ---------------------------------------------------------------------------
# Model split, fit and scoring (ML-*)
# ---------------------------------------------------------------------------

@register("ml_01", f"SELECT o_orderkey, {split_sql('o_orderkey')} AS is_test FROM orders")
def ml_01(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", test_flag(F.col("o_orderkey")).alias("is_test"))


@register("ml_02", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept
FROM lineitem
""")
def ml_02(spark, sf_dir):
    from wattline.ml.models import linear_regression
    li = S.table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    model = linear_regression(["l_quantity"], "l_extendedprice").fit(li).stages[-1]
    return spark.range(1).select(F.round(F.lit(float(model.coefficients[0])), 4).alias("slope"),
                                 F.round(F.lit(float(model.intercept)), 4).alias("intercept"))


_OLS2_SQL = """
SELECT round(b1, 4) AS b_quantity, round(b2, 4) AS b_discount, round(my - b1 * m1 - b2 * m2, 4) AS intercept
FROM (
  SELECT (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
         (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2, m1, m2, my
  FROM (SELECT covar_pop(l_quantity, l_quantity) AS s11, covar_pop(l_discount, l_discount) AS s22,
               covar_pop(l_quantity, l_discount) AS s12, covar_pop(l_quantity, l_extendedprice) AS s1y,
               covar_pop(l_discount, l_extendedprice) AS s2y,
               avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_extendedprice) AS my FROM lineitem) m) b
"""


@register("ml_02_two", _OLS2_SQL)
def ml_02_two(spark, sf_dir):
    from wattline.ml.models import linear_regression
    li = S.table(spark, sf_dir, "lineitem").select("l_quantity", "l_discount", "l_extendedprice")
    model = linear_regression(["l_quantity", "l_discount"], "l_extendedprice").fit(li).stages[-1]
    c = [float(x) for x in model.coefficients]
    return spark.range(1).select(F.round(F.lit(c[0]), 4).alias("b_quantity"),
                                 F.round(F.lit(c[1]), 4).alias("b_discount"),
                                 F.round(F.lit(float(model.intercept)), 4).alias("intercept"))


def _part_points(spark, sf_dir):
    p = S.table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey"), F.col("p_size").cast("double").alias("size"),
                    to_number(F.substring_index("p_brand", "#", -1)).alias("brand"),
                    F.col("p_retailprice"), test_flag(F.col("p_partkey")).alias("is_test"))


_PART_SQL = (f"SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS size, "
             f"CAST(split_part(p_brand, '#', 2) AS DOUBLE) AS brand, p_retailprice AS y, "
             f"{split_sql('p_partkey')} AS is_test FROM part")

_KNN_SQL = f"""
SELECT qid AS p_partkey, round(avg(y), 6) AS prediction FROM (
  SELECT q.id AS qid, t.y,
         row_number() OVER (PARTITION BY q.id ORDER BY (q.size - t.size) * (q.size - t.size)
                                                   + (q.brand - t.brand) * (q.brand - t.brand), t.id) AS rn
  FROM ({_PART_SQL}) q JOIN ({_PART_SQL}) t ON q.is_test AND NOT t.is_test) r
WHERE rn <= 7 GROUP BY qid
"""


@register("ml_04", _KNN_SQL)
def ml_04(spark, sf_dir):
    pts = _part_points(spark, sf_dir)
    train = pts.where(~F.col("is_test"))
    test = pts.where(F.col("is_test"))
    pred = knn_predict(train, test, ["size", "brand"], "p_retailprice", "p_partkey", k=7)
    return pred.select("p_partkey", F.round("prediction", 6).alias("prediction"))


_MODELS_SQL = """
  SELECT 'scaled' AS model, 0 AS ordinal, o_totalprice AS label, 0.9 * o_totalprice + 1000 AS prediction FROM orders
  UNION ALL SELECT 'exact', 1, o_totalprice, o_totalprice FROM orders
  UNION ALL SELECT 'mean', 2, o_totalprice, (SELECT avg(o_totalprice) FROM orders) FROM orders
  UNION ALL SELECT 'exact_again', 3, o_totalprice, o_totalprice FROM orders"""


def _model_predictions(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders").select(F.col("o_totalprice").alias("label"))
    mean = o.agg(F.avg("label")).scalar()
    preds = [("scaled", 0, F.lit(0.9) * F.col("label") + F.lit(1000)), ("exact", 1, F.col("label")),
             ("mean", 2, mean), ("exact_again", 3, F.col("label"))]
    frames = [o.select(F.lit(n).alias("model"), F.lit(i).alias("ordinal"), "label",
                       p.cast("double").alias("prediction")) for n, i, p in preds]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])


@register("ml_07", f"""
SELECT model, ordinal, round({_R2_SQL}, 8) AS r2, round({_RMSE_SQL}, 4) AS rmse, round({_MAPE_SQL}, 6) AS mape,
       count(*) AS n, count(*) FILTER (WHERE label = 0) AS zero_labels
FROM ({_MODELS_SQL}) p GROUP BY model, ordinal
""")
def ml_07(spark, sf_dir):
    m = M.evaluate(_model_predictions(spark, sf_dir), by=["model", "ordinal"])
    return m.select("model", "ordinal", F.round("r2", 8).alias("r2"), F.round("rmse", 4).alias("rmse"),
                    F.round("mape", 6).alias("mape"), "n", "zero_labels")


@register("ml_08", f"""
SELECT arg_max(model, (r2, -ordinal)) FILTER (WHERE r2 > -999 AND NOT isnan(r2)) AS best_model,
       round(max(r2) FILTER (WHERE r2 > -999 AND NOT isnan(r2)), 8) AS best_r2
FROM (SELECT model, ordinal, {_R2_SQL} AS r2 FROM ({_MODELS_SQL}) p GROUP BY model, ordinal) m
""")
def ml_08(spark, sf_dir):
    m = M.evaluate(_model_predictions(spark, sf_dir), by=["model", "ordinal"])
    return M.best_model(m).select("best_model", F.round("best_r2", 8).alias("best_r2"))


# ---------------------------------------------------------------------------
# Sinks (SNK-*): each writes a fresh table under the shared folder and
# returns what was stored, read back from the files.
# ---------------------------------------------------------------------------

_KEYED = S.CONSUMPTION_KEY
_TABLE_COLS = '"périmètre", nature, date, heures, consommation'


def _write_stored(spark, rows, path):
    stored = tables.first_per_key(S.stored_rows(rows), _KEYED, ["event_id"]).drop("event_id")
    tables.append(stored, path)


@register("snk_01", f"""
SELECT {_TABLE_COLS} FROM ({S.first_per_key_sql(S.STORED_SQL, _KEYED, 'event_id')}) s
UNION ALL
SELECT {_TABLE_COLS} FROM ({S.not_exists_sql(S.first_per_key_sql(S.CONSUMPTION_SQL, _KEYED, 'event_id'),
                                              S.STORED_SQL, _KEYED)}) n
""")
def snk_01(spark, sf_dir):
    rows = S.consumption_rows(S.table(spark, sf_dir, "events"))
    path = fresh_location(spark, "consumption")
    _write_stored(spark, rows, path)
    tables.insert_if_absent(spark, path, rows, _KEYED, ["event_id"], return_inserted=False)
    return spark.read.parquet(path)


@register("snk_01_two_writers", f"""
SELECT {_TABLE_COLS} FROM ({S.first_per_key_sql(S.CONSUMPTION_SQL, _KEYED, 'event_id')}) s
""")
def snk_01_two_writers(spark, sf_dir):
    """Two loads of the same rows at once: every key goes in once, by either of them."""
    from concurrent.futures import ThreadPoolExecutor
    rows = S.consumption_rows(S.table(spark, sf_dir, "events"))
    path = fresh_location(spark, "consumption")
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda _: tables.insert_if_absent(spark, path, rows, _KEYED, ["event_id"], return_inserted=False), range(2)))
    return spark.read.parquet(path)


_DAILY_SQL = f"""
  SELECT "périmètre" || '_' || date AS db_id, "périmètre" AS city, date,
         CAST(consommation AS DOUBLE) AS reading, event_id, nature FROM ({S.CONSUMPTION_SQL}) c"""


def _daily(rows):
    return rows.select(F.concat_ws("_", "périmètre", "date").alias("db_id"), F.col("périmètre").alias("city"),
                       "date", F.col("consommation").cast("double").alias("reading"), "event_id", "nature")


@register("snk_02", f"""
SELECT db_id, city, date, reading FROM ({S.not_exists_sql(
    S.first_per_key_sql(_DAILY_SQL, ['db_id'], 'event_id'),
    f"SELECT * FROM ({_DAILY_SQL}) d WHERE nature = 'purchase'", ['db_id'])}) n
""")
def snk_02(spark, sf_dir):
    daily = _daily(S.consumption_rows(S.table(spark, sf_dir, "events")))
    path = fresh_location(spark, "daily")
    first_purchase = tables.first_per_key(daily.where(F.col("nature") == "purchase"), ["db_id"], ["event_id"])
    tables.append(first_purchase.select("db_id", "city", "date", "reading"), path)
    inserted = tables.insert_if_absent(spark, path, daily.drop("nature"), ["db_id"], ["event_id"])
    return inserted


@register("snk_03", f"""
SELECT {_TABLE_COLS} FROM ({S.STORED_SQL}) s
UNION ALL SELECT {_TABLE_COLS} FROM ({S.CONSUMPTION_SQL}) c
""")
def snk_03(spark, sf_dir):
    rows = S.consumption_rows(S.table(spark, sf_dir, "events")).drop("event_id")
    path = fresh_location(spark, "appended")
    tables.append(S.stored_rows(rows), path)
    tables.append(rows, path)
    return spark.read.parquet(path)


def _snk04_sql() -> str:
    given = {"périmètre": '"périmètre"', "nature": "nature", "date": "date", "heures": "heures",
             "consommation": "CAST(consommation AS INTEGER)"}
    cols = []
    for c in CONSUMPTION_COLUMNS:
        if c in given:
            cols.append(f'{given[c]} AS "{c}"')
        else:
            t = "VARCHAR" if c == "stockage_batterie" else "INTEGER"
            cols.append(f'CAST(NULL AS {t}) AS "{c}"')
    return f"SELECT {', '.join(cols)} FROM ({S.CONSUMPTION_SQL}) c"


@register("snk_04", _snk04_sql())
def snk_04(spark, sf_dir):
    from wattline.contracts import CONSUMPTION_TABLE_SCHEMA
    rows = S.consumption_rows(S.table(spark, sf_dir, "events")).drop("event_id")
    path = fresh_location(spark, "consumption40")
    tables.create_table_if_absent(spark, path, CONSUMPTION_TABLE_SCHEMA)
    tables.create_table_if_absent(spark, path, CONSUMPTION_TABLE_SCHEMA)  # second call: no-op
    conformed = clean.conform_by_name(rows, CONSUMPTION_COLUMNS)
    tables.append(tables.to_table_schema(conformed, CONSUMPTION_TABLE_SCHEMA), path)
    return spark.read.parquet(path)


def _raw_consumption(ev):
    """Raw text readings: fractional text for clicks, 32-bit overflow for large values."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    text = (F.when(F.col("event_type") == "click", F.col("value").cast("string"))
            .when(F.col("value") > 300, (cents * 10000000).cast("string"))
            .otherwise(cents.cast("string")))
    return ev.select("event_id", F.col("event_type").alias("nature"), text.alias("consommation"))


_RAW_SQL = """
  SELECT event_id, event_type AS nature,
         CASE WHEN event_type = 'click' THEN CAST(value AS VARCHAR)
              WHEN value > 300 THEN CAST(CAST(round(value * 100) AS BIGINT) * 10000000 AS VARCHAR)
              ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END AS consommation
  FROM events"""


def _reasons_sql(c: str) -> str:
    i64 = S.int64_sql(c)
    num = S.number_sql(c)
    frac = f"(({num}) IS NOT NULL AND ({i64}) IS NULL)"
    over = f"(({i64}) < -2147483648 OR ({i64}) > 2147483647)"
    beyond = f"(isinf({num}) OR ({num}) = floor({num}))"
    return (f"list_filter([CASE WHEN {frac} AND {beyond} THEN '{c}:int64' WHEN {frac} THEN '{c}:fraction' END, CASE WHEN COALESCE({over}, false) "
            f"THEN '{c}:int32' END], lambda x: x IS NOT NULL)")


@register("snk_06_valid", f"""
SELECT event_id, nature, CAST({S.int64_sql('consommation')} AS INTEGER) AS consommation
FROM ({_RAW_SQL}) r WHERE len({_reasons_sql('consommation')}) = 0
""")
def snk_06_valid(spark, sf_dir):
    raw = _raw_consumption(S.table(spark, sf_dir, "events"))
    valid, _ = tables.split_valid(raw, clean.reject_reasons(raw, ["consommation"]))
    return valid.select("event_id", "nature", to_int64(F.col("consommation")).cast("int").alias("consommation"))


@register("snk_06_rejected", f"""
SELECT event_id, consommation, array_to_string({_reasons_sql('consommation')}, ',') AS reasons
FROM ({_RAW_SQL}) r WHERE len({_reasons_sql('consommation')}) > 0
""")
def snk_06_rejected(spark, sf_dir):
    raw = _raw_consumption(S.table(spark, sf_dir, "events"))
    _, rejected = tables.split_valid(raw, clean.reject_reasons(raw, ["consommation"]))
    return rejected.select("event_id", "consommation", F.array_join("reasons", ",").alias("reasons"))


@register("snk_08", """
SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS "year" FROM orders
WHERE year(o_orderdate) = 1997
""")
def snk_08(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders")
    path = fresh_location(spark, "by_year")
    tables.append(o.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year")), path,
                  partition_by=["year"])
    back = spark.read.parquet(path)
    return back.where(F.col("year") == 1997).select("o_orderkey", "o_totalprice", "year")


@register("snk_09", f"SELECT * FROM ({S.HOURLY_SQL}) h")
def snk_09(spark, sf_dir):
    path = fresh_location(spark, "conso_features")
    hourly_rows = hourly.aggregate_hourly(_readings(spark, sf_dir), order_cols=["_row_order"])
    tables.append(hourly_rows, path)
    return spark.read.parquet(path)


@register("snk_09_weather", S.WEATHER_HOURLY_SQL)
def snk_09_weather(spark, sf_dir):
    path = fresh_location(spark, "meteo_data")
    hourly_wx = weather.expand_blocks(S.weather_blocks(S.table(spark, sf_dir, "embeddings")))
    tables.append(hourly_wx.withColumn("date", F.col("date").cast("timestamp_ntz")), path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------------------
# File loading over files derived from `events` (SRC-01..06): the readings
# are written as Latin-1 delimited text, ';' for views and clicks and tab
# for the rest, into one directory, then loaded back by separator sniffing.
# ---------------------------------------------------------------------------

@register("src_06", """
SELECT CASE WHEN nature IN ('view', 'click') THEN 'semi.csv' WHEN nature = 'error' THEN 'comma.CSV' ELSE 'tab.xls' END AS source_file,
       nature, CASE WHEN nature = 'error' THEN 'zone "' || perimetre || '"' || chr(10) || 'line; two' ELSE perimetre END AS place,
       count(*) AS n, CAST(sum(_row_order) AS BIGINT) AS ids
FROM (""" + S.READINGS_SQL + """) r GROUP BY ALL
""")
def src_06(spark, sf_dir):
    """Three files of different separators, one with quotes and line breaks in its cells, beside others the loader must
    leave alone (another extension, a folder): every row with the file it came from (SRC-01 to 06)."""
    from wattline.sources.delimited import load_all_data
    r = _readings(spark, sf_dir).select("perimetre", "nature", F.col("_row_order").alias("id"))
    path = fresh_location(spark, "landing")
    place = F.when(F.col("nature") == "error", F.concat(F.lit('zone "'), "perimetre", F.lit('"\nline; two'))).otherwise(
        F.col("perimetre")).alias("place")
    kinds = {"semi.csv": (";", F.col("nature").isin("view", "click")), "comma.CSV": (",", F.col("nature") == "error"),
             "tab.xls": ("\t", ~F.col("nature").isin("view", "click", "error")), "notes.txt": (";", F.lit(True))}
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    for name, (sep, chosen) in kinds.items():
        (r.where(chosen).select("nature", place, "id").coalesce(1).write.option("header", "true").option("sep", sep)
         .option("escape", '"').option("encoding", "ISO-8859-1").csv(f"{path}/_{name}"))
        folder = fs.Path(f"{path}/_{name}")
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        part = next(s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith("part-"))
        files.rename(part, fs.Path(f"{path}/{name}"))
    return load_all_data(spark, path).groupBy("source_file", "nature", "place").agg(
        F.count("*").alias("n"), F.sum(F.col("id").cast("long")).alias("ids"))


@register("src_01", """
SELECT perimetre, nature, date, heures,
       CASE WHEN consommation IN ('NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null') THEN NULL
            ELSE consommation END AS consommation
FROM (""" + S.READINGS_SQL + ") r")
def src_01(spark, sf_dir):
    from wattline.sources.delimited import load_all_data
    r = _readings(spark, sf_dir).drop("_row_order", "source_file")
    path = fresh_location(spark, "landing")
    semi = r.where(F.col("nature").isin("view", "click"))
    tab = r.where(~F.col("nature").isin("view", "click"))
    for part, sep in ((semi, ";"), (tab, "\t")):
        (part.write.mode("append").option("header", "true").option("sep", sep)
         .option("encoding", "ISO-8859-1").csv(path))
    loaded = load_all_data(spark, path)
    return loaded.select("perimetre", "nature", "date", "heures", "consommation")


# ---------------------------------------------------------------------------
# Model fits on the hourly feature rows (rows-only checks: Spark's learners
# are not bit-comparable to a SQL oracle)
# ---------------------------------------------------------------------------

def _training_rows(spark, sf_dir):
    from wattline.plans.training import hourly_training_rows
    return hourly_training_rows(_readings(spark, sf_dir), order_cols=["_row_order"])


@register("ml_03")
def ml_03(spark, sf_dir):
    from wattline.ml.models import random_forest
    rows = _training_rows(spark, sf_dir)
    feats = [c for c in rows.columns if c not in ("row_id", "is_test", "consommation")]
    train, test = rows.where(~F.col("is_test")), rows.where(F.col("is_test"))
    model = random_forest(feats).fit(train)
    return M.evaluate(model.transform(test).select(F.col("consommation").alias("label"), "prediction"))


@register("ml_05")
def ml_05(spark, sf_dir):
    from wattline.plans.training import run_training
    res = run_training(spark, _readings(spark, sf_dir), order_cols=["_row_order"])
    return res.metrics


# One-variable least squares on the training share, so SQL's regr_* functions give the same line.
_HOUR_LINE_SQL = f"""
  WITH h AS (SELECT CAST(epoch(datetime) AS BIGINT) AS row_id, hour(datetime) AS x,
                    COALESCE({S.number_sql('consommation')}, 0.0) AS y FROM ({S.HOURLY_SQL}) h),
       t AS (SELECT *, {split_sql('row_id')} AS is_test FROM h),
       m AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM t WHERE NOT is_test)
  SELECT row_id, y AS label, round(slope * x + intercept, 4) AS prediction FROM t, m WHERE is_test"""


def _hour_line(spark, sf_dir):
    from wattline.ml.models import linear_regression
    rows = _training_rows(spark, sf_dir)
    return linear_regression(["hour"]).fit(rows.where(~F.col("is_test"))), rows.where(F.col("is_test"))


def _line_predictions(model, rows):
    from wattline.ml.models import predict
    return predict(model, rows, id_col="row_id").withColumn("prediction", F.round("prediction", 4))


@register("ml_06", _HOUR_LINE_SQL)
def ml_06(spark, sf_dir):
    return _line_predictions(*_hour_line(spark, sf_dir))


@register("ml_10", """
SELECT 'hour_line' AS name, '1' AS version, 'pipeline' AS kind, count(*) > 0 AS learned FROM events
UNION ALL SELECT 'hour_line', '2', 'pipeline', count(*) > 0 FROM events
UNION ALL SELECT 'other_line', '1', 'pipeline', count(*) > 0 FROM events
""")
def ml_10(spark, sf_dir):
    """Registry rows after three pushes of a saved model (ML-09, ML-10), without times and random ids."""
    from wattline.ml import registry
    root = fresh_location(spark, "registry")
    model, _ = _hour_line(spark, sf_dir)
    for name in ("hour_line", "other_line", "hour_line"):
        registry.push(spark, root, name, model)
    return spark.read.parquet(f"{root}/_registry").select("name", "version", "kind", F.lit(True).alias("learned"))


@register("ml_11", _HOUR_LINE_SQL)
def ml_11(spark, sf_dir):
    """Predictions of the latest registered version, read back from the registry."""
    from wattline.ml import registry
    root = fresh_location(spark, "registry")
    model, rows = _hour_line(spark, sf_dir)
    registry.push(spark, root, "hour_line", model)
    registry.push(spark, root, "hour_line", model)
    return _line_predictions(registry.pull(spark, root, "hour_line"), rows)


@register("final_features", f"""
SELECT h.consommation, h."year", h."hour", h."day", h."month", h.dayofweek, h.weekend,
       round(COALESCE(w.temperature_2m, 0.0), 6) AS temperature_2m
FROM (SELECT datetime, COALESCE({S.number_sql('consommation')}, 0.0) AS consommation,
             CAST(year(datetime) AS INTEGER) AS "year", {S.calendar_sql('datetime')} FROM ({S.HOURLY_SQL}) x) h
LEFT JOIN (SELECT hour_ts, avg(temperature_2m) AS temperature_2m FROM (
             SELECT event_type, date_trunc('hour', ts) + INTERVAL 1 HOUR AS hour_ts, avg(value) AS temperature_2m
             FROM events WHERE event_type <> 'error' GROUP BY 1, 2) c GROUP BY 1) w ON w.hour_ts = h.datetime
""")
def final_features(spark, sf_dir):
    """Hourly consumption joined with weather, as written by the plan: the January weather is UTC, readings are
    an hour ahead."""
    from wattline.plans.training import write_features
    ev = S.table(spark, sf_dir, "events")
    wx = (ev.where(F.col("event_type") != "error")
          .groupBy(F.col("event_type").alias("city"), F.date_trunc("hour", F.col("ts")).cast("timestamp").alias("date"))
          .agg(F.avg("value").alias("temperature_2m")))
    path = fresh_location(spark, "final_features")
    write_features(_readings(spark, sf_dir), path, wx, order_cols=["_row_order"])
    return spark.read.parquet(path).withColumn("temperature_2m", F.round("temperature_2m", 6))


@register("snk_01_by_year", f"""
SELECT event_id, CAST(CASE WHEN value < 0.5 THEN NULL ELSE 2020 + user_id % 4 END AS INTEGER) AS "year" FROM events
""")
def snk_01_by_year(spark, sf_dir):
    """Rows with and without a year, loaded twice into a table partitioned by year: each key once."""
    ev = S.table(spark, sf_dir, "events").select("event_id", F.when(F.col("value") >= 0.5, (
        F.lit(2020) + F.col("user_id") % 4).cast("int")).alias("year"), F.col("event_id").alias("_order"))
    path = fresh_location(spark, "by_year")
    for _ in range(2):
        tables.insert_if_absent(spark, path, ev, ["event_id"], ["_order"], partition_by=["year"], return_inserted=False)
    return spark.read.parquet(path).select("event_id", F.col("year").cast("int").alias("year"))


# ---------------------------------------------------------------------------
# Daily weather and city-location tables from JSON documents derived from
# the tables (SRC-11 + SNK-05, SRC-12 + SNK-07)
# ---------------------------------------------------------------------------

def _forecast_docs(spark, sf_dir):
    """One forecast JSON per order: city = priority, dt = order date (epoch s)."""
    o = S.table(spark, sf_dir, "orders")
    p = F.col("o_totalprice")
    doc = F.to_json(F.struct(
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("dt"),
        F.struct((p / 1000).alias("min"), (p / 500).alias("max")).alias("T"),
        F.struct((F.col("o_custkey") % 100).alias("min"), (F.col("o_custkey") % 100 + 1).alias("max")).alias("humidity"),
        F.struct((p / 10000).alias("24h")).alias("precipitation"),
        (F.col("o_orderkey") % 11).alias("uv"),
        F.when(F.col("o_orderstatus") != "P",
               F.struct(F.col("o_orderstatus").alias("icon"), F.col("o_orderpriority").alias("desc")))
         .alias("weather12H"),
        F.struct(F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("rise"),
                 (F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + 3600).alias("set")).alias("sun"),
    ))
    return o.select(F.col("o_orderpriority").alias("city"), (F.col("o_custkey") / 1000).alias("latitude"),
                    (F.col("o_orderkey") / 1000).alias("longitude"), doc.alias("forecast"), "o_orderkey")


_FORECAST_SQL = """
  SELECT o_orderpriority || '_' || CAST(epoch(o_orderdate) AS BIGINT) AS db_id,
         CAST(epoch(o_orderdate) AS BIGINT) AS dt,
         CAST(o_totalprice / 1000 AS FLOAT) AS min_temp, CAST(o_totalprice / 500 AS FLOAT) AS max_temp,
         CAST(o_custkey % 100 AS INTEGER) AS min_humidity, CAST(o_custkey % 100 + 1 AS INTEGER) AS max_humidity,
         CAST(o_totalprice / 10000 AS FLOAT) AS precipitation, CAST(o_orderkey % 11 AS INTEGER) AS uv,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS weather_icon,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS weather_desc,
         CAST(epoch(o_orderdate) AS BIGINT) AS sunrise, CAST(epoch(o_orderdate) AS BIGINT) + 3600 AS sunset,
         CAST(o_custkey / 1000 AS FLOAT) AS latitude, CAST(o_orderkey / 1000 AS FLOAT) AS longitude,
         o_orderpriority AS city, o_orderkey
  FROM orders"""


@register("snk_05", f"""
SELECT db_id, dt, min_temp, max_temp, min_humidity, max_humidity, precipitation, uv, weather_icon,
       weather_desc, sunrise, sunset, latitude, longitude, city
FROM ({S.first_per_key_sql(_FORECAST_SQL, ['db_id'], 'o_orderkey')}) f
""")
def snk_05(spark, sf_dir):
    from wattline.contracts import WEATHER_DAILY_SCHEMA
    docs = _forecast_docs(spark, sf_dir)
    flat = weather.flatten_forecast(docs, keep=["o_orderkey"])
    valid, _ = tables.split_valid(flat, tables.null_violations(["db_id", "dt"]))
    path = fresh_location(spark, "daily_weather")
    tables.create_table_if_absent(spark, path, WEATHER_DAILY_SCHEMA)
    tables.insert_if_absent(spark, path, valid, ["db_id"], ["o_orderkey"], schema=WEATHER_DAILY_SCHEMA)
    return spark.read.parquet(path)


def _city_docs(spark, sf_dir):
    c = S.table(spark, sf_dir, "customer")
    n = S.table(spark, sf_dir, "nation")
    r = S.table(spark, sf_dir, "region")
    rows = (c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
            .join(r, F.col("n_regionkey") == r["r_regionkey"], "left"))
    city = F.struct(
        F.col("c_custkey").cast("string").alias("insee_code"),
        F.col("c_name").alias("city_code"),
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("zip-"), F.col("c_name")))
         .otherwise(F.col("c_nationkey").cast("string")).alias("zip_code"),
        F.col("c_mktsegment").alias("label"),
        F.col("c_acctbal").cast("string").alias("latitude"),
        F.col("c_nationkey").cast("string").alias("longitude"),
        F.col("n_name").alias("department_name"),
        F.col("n_nationkey").cast("string").alias("department_number"),
        F.col("r_name").alias("region_name"),
        F.lower(F.col("r_name")).alias("region_geojson_name"),
    )
    return rows.select(F.to_json(F.struct(F.array(city).alias("cities"))).alias("value"))


_CITY_SQL = """
  SELECT CAST(c.c_custkey AS VARCHAR) AS insee_code, c.c_name AS city_code,
         CASE WHEN c.c_acctbal < 0 THEN 'zip-' || c.c_name ELSE CAST(c.c_nationkey AS VARCHAR) END AS zip_code,
         c.c_mktsegment AS label, CAST(c.c_acctbal AS VARCHAR) AS latitude, CAST(c.c_nationkey AS VARCHAR) AS longitude,
         n.n_name AS department_name, CAST(n.n_nationkey AS VARCHAR) AS department_number,
         r.r_name AS region_name, lower(r.r_name) AS region_geojson_name
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""

_CITY_LIMITS_SQL = "length(zip_code) <= 10 AND length(insee_code) <= 10 AND length(city_code) <= 50"


@register("snk_07", f"SELECT * FROM ({_CITY_SQL}) c WHERE {_CITY_LIMITS_SQL}")
def snk_07(spark, sf_dir):
    from wattline.contracts import CITY_LOCATION_COLUMNS, CITY_LOCATION_SCHEMA
    cities = weather.explode_cities(_city_docs(spark, sf_dir))
    valid, _ = tables.split_valid(cities, tables.length_violations(CITY_LOCATION_COLUMNS))
    path = fresh_location(spark, "city_locations")
    tables.create_table_if_absent(spark, path, CITY_LOCATION_SCHEMA)
    tables.append(valid, path)
    return spark.read.parquet(path)


@register("snk_07_rejected", f"""
SELECT insee_code, array_to_string(list_filter([
    CASE WHEN length(insee_code) > 10 THEN 'insee_code:length>10' END,
    CASE WHEN length(city_code) > 50 THEN 'city_code:length>50' END,
    CASE WHEN length(zip_code) > 10 THEN 'zip_code:length>10' END], lambda x: x IS NOT NULL), ',') AS reasons
FROM ({_CITY_SQL}) c WHERE NOT ({_CITY_LIMITS_SQL})
""")
def snk_07_rejected(spark, sf_dir):
    from wattline.contracts import CITY_LOCATION_COLUMNS
    cities = weather.explode_cities(_city_docs(spark, sf_dir))
    _, rejected = tables.split_valid(cities, tables.length_violations(CITY_LOCATION_COLUMNS))
    return rejected.select("insee_code", F.array_join("reasons", ",").alias("reasons"))


# ---------------------------------------------------------------------------
# Archive ingest over archives derived from `events` (SRC-07 + SRC-01): the
# readings are hashed into buckets of at most ~5,000 rows, each bucket is
# zipped as one ';'-separated Latin-1 member by the task holding it, then the
# archives are unpacked into a landing folder and loaded back.
# ---------------------------------------------------------------------------

_ZIP_BUCKET_ROWS = 5000
_READING_COLS = ["perimetre", "nature", "date", "heures", "consommation"]


def _zip_writer(archive_dir: str):
    def write(pdf):
        import io as _io
        import zipfile as _zipfile

        import pandas as _pd
        from wattline.sources.files import arrow_fs
        bucket = int(pdf["_bucket"].iloc[0])
        text = pdf.sort_values("_row_order")[_READING_COLS].to_csv(sep=";", index=False, na_rep="")
        buf = _io.BytesIO()
        with _zipfile.ZipFile(buf, "w", compression=_zipfile.ZIP_DEFLATED) as z:
            z.writestr(f"readings_{bucket:05d}.csv", text.encode("latin-1"))
        filesystem, root = arrow_fs(archive_dir)
        filesystem.create_dir(root, recursive=True)
        with filesystem.open_output_stream(f"{root}/readings_{bucket:05d}.zip") as out:
            out.write(buf.getvalue())
        return _pd.DataFrame({"bucket": [bucket], "rows": [len(pdf)]})
    return write


@register("src_07", """
SELECT perimetre, nature, date, heures,
       CASE WHEN consommation IN ('NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null') THEN NULL
            ELSE consommation END AS consommation
FROM (""" + S.READINGS_SQL + ") r")
def src_07(spark, sf_dir):
    from wattline.sources.archive import download_and_extract
    from wattline.sources.delimited import load_all_data
    r = _readings(spark, sf_dir).drop("source_file")
    buckets = max(1, -(-r.count() // _ZIP_BUCKET_ROWS))
    archive_dir = fresh_location(spark, "archives")
    landing = fresh_location(spark, "landing")
    bucketed = r.withColumn("_bucket", F.pmod(F.xxhash64("_row_order"), F.lit(buckets)))
    bucketed.groupBy("_bucket").applyInPandas(_zip_writer(archive_dir), "bucket long, rows long").write.format(
        "noop").mode("overwrite").save()
    download_and_extract(spark, archive_dir, landing)
    return load_all_data(spark, landing).select(*_READING_COLS)


# ---------------------------------------------------------------------------
# Header rules on a table whose columns carry raw, accented headers
# (PRJ-01 cleaning for loaded frames, PRJ-03 renaming for the table layer)
# ---------------------------------------------------------------------------

_RAW_HEADERS = ["  Clé Client ", "Nom?Client", "Nation - Clé", "Solde (€)", "Segment__"]
_TABLE_HEADERS = ["Périmètre", "Prévision J-1", "Taux?CO2", " Fioul-TAC ", "Gaz"]


@register("prj_01", """
SELECT c_custkey AS cle_client, c_name AS nomeclient, c_nationkey AS nation_cle,
       c_acctbal AS solde, c_mktsegment AS segment FROM customer
""")
def prj_01(spark, sf_dir):
    from wattline.functions.names import cleaned_headers
    raw = S.table(spark, sf_dir, "customer").toDF(*_RAW_HEADERS)
    return raw.toDF(*cleaned_headers(raw.columns))


@register("prj_03", """
SELECT c_custkey AS "périmètre", c_name AS "prévision_j_1", c_nationkey AS tauxeco2,
       c_acctbal AS fioul_tac, c_mktsegment AS gaz FROM customer
""")
def prj_03(spark, sf_dir):
    from wattline.functions.names import simple_rename
    raw = S.table(spark, sf_dir, "customer").toDF(*_TABLE_HEADERS)
    return raw.toDF(*[simple_rename(c) for c in raw.columns])
