import datetime as dt

from pyspark.sql import functions as F

from wattline.operators.hourly import aggregate_hourly, feature_table

SCHEMA = "perimetre string, date string, heures string, consommation string, source_file string, _block_start long, _row_id long"
ROWS = [
    ("France", "2012-01-01", "00:00", "58315", "a.xls", 0, 0),
    ("France", "2012-01-01", "00:15", None, "a.xls", 0, 1),
    ("France", "2012-01-01", "00:30", "ND", "a.xls", 0, 2),
    ("France", "2012-01-01", "01:00", "ND", "a.xls", 0, 3),
    (None, "2012-01-01", "01:30", "57231", "a.xls", 0, 4),
    ("France", "07/01/2012", "02:00", "1e3", "a.xls", 0, 5),
    ("France", None, "03:00", "1", "a.xls", 0, 6),
    ("France", "2012-13-01", "00:00", "1", "a.xls", 0, 7),
    ("France", "2012-01-02", "00:00", "12d", "a.xls", 0, 8),
    ("Corse", "2012-01-02", "00:00", "7", "b.xls", 0, 0),
]


def test_first_non_null_and_drops(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = {r["datetime"]: r for r in aggregate_hourly(df).collect()}
    assert set(out) == {dt.datetime(2012, 1, 1, 0), dt.datetime(2012, 1, 1, 1),
                        dt.datetime(2012, 1, 7, 2), dt.datetime(2012, 1, 2, 0)}
    assert out[dt.datetime(2012, 1, 1, 1)]["consommation"] == "57231"   # first non-null skips ND
    assert out[dt.datetime(2012, 1, 1, 1)]["perimetre"] == "France"     # per-column first non-null
    assert out[dt.datetime(2012, 1, 2, 0)]["consommation"] == "12d"     # a.xls before b.xls
    cols = aggregate_hourly(df).columns
    assert cols == ["datetime", "consommation", "date", "heures", "perimetre", "source_file"]


def test_calendar_and_target(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    feats = {(r["day"], r["month"], r["hour"]): r for r in feature_table(df).collect()}
    sat = feats[(7, 1, 2)]
    assert sat["dayofweek"] == 5 and sat["weekend"] == 1 and sat["consommation"] == 1000.0
    assert feats[(2, 1, 0)]["consommation"] == 0.0          # '12d' is not a number -> 0
    assert feats[(1, 1, 0)]["dayofweek"] == 6               # 2012-01-01 is a Sunday
    assert set(feature_table(df).columns) == {"consommation", "hour", "day", "month", "dayofweek", "weekend"}


def test_numeric_mean_mode(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = {r["datetime"]: r for r in aggregate_hourly(df, numeric="mean").collect()}
    assert out[dt.datetime(2012, 1, 1, 0)]["consommation"] == 58315.0
    assert out[dt.datetime(2012, 1, 2, 0)]["consommation"] == 7.0      # '12d' ignored, mean of 7


def test_partition_count_does_not_change_result(spark):
    df = spark.createDataFrame(ROWS * 3, SCHEMA)
    want = sorted(map(tuple, feature_table(df.coalesce(1)).collect()))
    for n in (4, 17):
        assert sorted(map(tuple, feature_table(df.repartition(n)).collect())) == want


def test_hourly_keys_unique(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    from wattline.plans.standins import readings
    out = aggregate_hourly(readings(ev), order_cols=["_row_order"])
    assert out.count() == out.select("datetime").distinct().count()
    assert out.where(F.col("datetime").isNull()).count() == 0


def test_one_number_order_equals_the_struct_order(spark):
    """The hash path (one ordinal) against the general one, also for nulls, bad numbers and a null ordinal."""
    rows = [(d, h, c, p, o) for o, (d, h, c, p) in enumerate(
        (f"2012-01-0{1 + i % 3}", f"0{i % 4}:{'00' if i % 5 else '30'}:{i % 60:02d}", [None, "ND", "1,5", "12d", str(i), f" {i}.5 "][i % 6],
         [None, "x", "7"][i % 3]) for i in range(400))]
    df = spark.createDataFrame(rows + [("2012-01-01", "00:00:00", "-3", "9", None)],
                               "date string, heures string, consommation string, prev string, o long")
    got = sorted(map(tuple, feature_table(df.drop("x"), ["o"]).collect()))
    general = df.withColumn("p", F.lit(0))
    want = sorted(map(tuple, feature_table(general, ["p", "o"]).drop("p").collect()))
    assert got == want and len(got) > 10
    for n in (3, 11):
        assert sorted(map(tuple, feature_table(df.repartition(n), ["o"]).collect())) == got


def test_an_ordinal_out_of_range_is_an_error(spark):
    import pytest
    for bad in (-2, 2 ** 51):
        df = spark.createDataFrame([("2012-01-01", "00:00", "1", bad)], "date string, heures string, consommation string, o long")
        with pytest.raises(Exception, match="beyond 51 bits"):
            feature_table(df, ["o"]).collect()
