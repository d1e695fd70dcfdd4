import os

from conftest import write
from wattline.contracts import CONSUMPTION_COLUMNS
from wattline.plans.table_load import load_table
from wattline.plans.training import run_training
from wattline.streaming import start_incremental_load

HEAD = "Périmètre;Nature;Date;Heures;Consommation;Prévision J-1"


def _file(path, rows):
    write(path, "\n".join([HEAD] + rows) + "\n")


def test_table_load_idempotent(spark, workdir):
    d = os.path.join(workdir, "in")
    _file(os.path.join(d, "a.csv"), ["France;Déf;2012-01-01;00:00;58315;1", "France;Déf;2012-01-01;00:00;1;1",
                                     "France;Déf;2012-01-01;00:30;1.5;1", "France;Déf;2012-01-01;01:00;3000000000;1",
                                     "France;Déf;2012-01-01;01:30;1e3;ND"])
    t, r = os.path.join(workdir, "t"), os.path.join(workdir, "r")
    first = load_table(spark, d, t, r)
    assert first == {"inserted": 2, "rejected": 2}
    table = spark.read.parquet(t)
    assert table.columns == CONSUMPTION_COLUMNS
    rows = {x["heures"]: x for x in table.collect()}
    assert rows["00:00"]["consommation"] == 58315 and rows["01:30"]["consommation"] == 1000
    assert rows["01:30"]["prévision_j_1"] is None
    again = load_table(spark, d, t, r)
    assert again["inserted"] == 0 and spark.read.parquet(t).count() == 2


def test_table_load_by_year(spark, workdir):
    d = os.path.join(workdir, "in")
    _file(os.path.join(d, "a.csv"), ["France;Déf;2012-01-01;00:00;1;1", "France;Déf;01/01/2013;00:00;2;1"])
    t, r = os.path.join(workdir, "t"), os.path.join(workdir, "r")
    assert load_table(spark, d, t, r, by_year=True)["inserted"] == 2
    assert sorted(os.listdir(t))[:2] == ["_SUCCESS", "year=2012"] or "year=2013" in os.listdir(t)
    _file(os.path.join(d, "b.csv"), ["France;Déf;2012-01-01;00:00;5;1", "France;Déf;2014-01-01;00:00;3;1"])
    assert load_table(spark, d, t, r, by_year=True)["inserted"] == 1
    assert spark.read.parquet(t).count() == 3


def test_incremental_stream_loads_new_files_once(spark, workdir):
    land = os.path.join(workdir, "land")
    t, r = os.path.join(workdir, "t"), os.path.join(workdir, "r")
    ck = os.path.join(workdir, "ck")
    _file(os.path.join(land, "a.csv"), ["France;Déf;2012-01-01;00:00;1;1"])
    start_incremental_load(spark, land, t, r, checkpoint=ck).awaitTermination(120)
    assert spark.read.parquet(t).count() == 1
    _file(os.path.join(land, "b.csv"), ["France;Déf;2012-01-01;00:00;9;1", "France;Déf;2012-01-02;00:00;2;1"])
    start_incremental_load(spark, land, t, r, checkpoint=ck).awaitTermination(120)
    assert spark.read.parquet(t).count() == 2        # existing key not duplicated


def test_training_run_registers_best(spark, workdir):
    from wattline.plans import standins as S
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    res = run_training(spark, S.readings(ev), order_cols=["_row_order"],
                       registry_root=os.path.join(workdir, "reg"), forest_depth=5)
    m = {x["model"]: x for x in res.metrics.collect()}
    assert set(m) == {"LinearRegression", "RandomForest", "KNN"}
    assert res.best in m and res.version == 1
    assert res.best_r2 == max(x["r2"] for x in m.values())


def test_training_rows_with_weather(spark):
    from pyspark.sql import functions as F
    from wattline.plans.training import hourly_training_rows
    readings = spark.createDataFrame(
        [("2020-01-01", "00:00", "100", 0), ("2020-01-01", "01:00", "200", 1), ("2020-01-01", "02:00", "300", 2)],
        "date string, heures string, consommation string, _row_id long")
    wx = spark.createDataFrame(
        [("Paris", "2020-01-01 00:00:00", 2.0, 80.0), ("Lille", "2020-01-01 00:00:00", 4.0, 90.0),
         ("Paris", "2020-01-01 01:00:00", 6.0, 70.0)],
        "city string, date string, temperature_2m double, relative_humidity_2m double"
    ).withColumn("date", F.to_timestamp("date"))
    rows = {r["hour"]: r for r in hourly_training_rows(readings, ["_row_id"], weather=wx).collect()}
    # midnight UTC is one o'clock on the readings' clock
    assert rows[1]["temperature_2m"] == 3.0 and rows[2]["temperature_2m"] == 6.0
    assert rows[0]["temperature_2m"] == 0.0          # no weather that hour -> 0 after the fill
    assert rows[0]["consommation"] == 100.0
