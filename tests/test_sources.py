import io
import json
import os
import zipfile

from pyspark.sql import functions as F

from wattline.sources import weather, years
from wattline.sources.archive import download_and_extract


def test_expand_blocks_edges(spark):
    blocks = spark.createDataFrame([
        ("A", 0, 7200, 3600, [1.0, 2.0], [1.0, 2.0], [0.0, 0.0], [0.0, 0.0], [3.0, 3.0]),
        ("B", 100, 100, 3600, [], [], [], [], []),                       # end = start: nothing
        ("C", 0, 3600, 3600, [5.0], [5.0], [5.0], [5.0], [5.0]),         # one step
        ("D", 0, 7200, 3600, [1.0], [1.0], [1.0], [1.0], [1.0]),         # arrays too short
    ], "city string, time long, time_end long, interval int, temperature_2m array<float>, "
       "relative_humidity_2m array<float>, snowfall array<float>, precipitation array<float>, "
       "weather_code array<float>")
    out = weather.expand_blocks(blocks).orderBy("city", "date").collect()
    assert [(r["city"], r["temperature_2m"]) for r in out] == [("A", 1.0), ("A", 2.0), ("C", 5.0)]
    errs = weather.block_errors(blocks).collect()
    assert [e["city"] for e in errs] == ["D"]


def test_city_dimension_and_join(spark):
    dim = weather.city_dimension(spark)
    assert dim.count() == 21
    facts = spark.createDataFrame([("Paris", 1.0), ("Atlantis", 2.0)], "city string, v double")
    joined = {r["city"]: r["latitude"] for r in weather.attach_dimension(facts, dim, "city").collect()}
    assert joined["Paris"] == 48.8566 and joined["Atlantis"] is None
    assert [r["city"] for r in weather.unmatched(facts, dim, "city").collect()] == ["Atlantis"]


def test_flatten_forecast(spark):
    rec = {"dt": 1700000000, "T": {"min": 1.5, "max": 9.0}, "humidity": {"min": 40, "max": 90},
           "precipitation": {"24h": 2.5}, "uv": 3, "weather12H": {"icon": "p1", "desc": "Sunny"},
           "sun": {"rise": 1700020000, "set": 1700050000}}
    no_w = dict(rec)
    no_w.pop("weather12H")
    df = spark.createDataFrame([("Paris", 48.85, 2.35, json.dumps(rec)), ("Nice", 43.7, 7.26, json.dumps(no_w))],
                               "city string, latitude double, longitude double, forecast string")
    out = {r["city"]: r for r in weather.flatten_forecast(df).collect()}
    assert out["Paris"]["db_id"] == "Paris_1700000000" and out["Paris"]["precipitation"] == 2.5
    assert out["Paris"]["weather_desc"] == "Sunny" and out["Nice"]["weather_icon"] is None
    assert len(weather.flatten_forecast(df).columns) == 15


def test_explode_cities(spark):
    doc = {"cities": [{"insee_code": "1", "label": "a"}, {"insee_code": "2", "label": "b"}]}
    df = spark.createDataFrame([(json.dumps(doc),)], "value string")
    out = weather.explode_cities(df)
    assert out.count() == 2 and len(out.columns) == 10


def test_contiguous_years(spark):
    df = spark.createDataFrame([(y,) for y in [2011, 2012, 2012, 2013, 2015, 2016]], "year int")
    assert [r["year"] for r in years.contiguous_years(df, 2012).orderBy("year").collect()] == [2012, 2013]
    assert years.contiguous_years(df, 2014).count() == 0


def test_archive_extract_skips_landed(spark, workdir):
    zdir, land = os.path.join(workdir, "zips"), os.path.join(workdir, "landing")
    os.makedirs(zdir)
    for name, members in [("y2012.zip", {"a.xls": b"x\ty\n1\t2\n", "dir/b.xls": b"p;q\n", "other/b.xls": b"s;t\n"}),
                          ("y2013.zip", {"c.xls": b"r;s\n"})]:
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as z:
            for m, data in members.items():
                z.writestr(m, data)
        with open(os.path.join(zdir, name), "wb") as f:
            f.write(buf.getvalue())
    first = download_and_extract(spark, zdir, land)
    assert sorted(r["member"] for r in first.collect()) == ["a.xls", "c.xls", "dir/b.xls", "other/b.xls"]
    assert open(os.path.join(land, "other", "b.xls"), "rb").read() == b"s;t\n"
    assert open(os.path.join(land, "a.xls"), "rb").read() == b"x\ty\n1\t2\n"
    assert download_and_extract(spark, zdir, land).count() == 0


def test_archive_member_must_stay_inside():
    import pytest

    from wattline.sources.archive import safe_member
    assert safe_member("a\\b/./c.csv") == "a/b/c.csv"
    for name in ("../x.csv", "/etc/x.csv", "a/../../x.csv", "C:/x.csv"):
        with pytest.raises(ValueError):
            safe_member(name)


def test_fetch_weather_from_landed_blocks(spark, workdir):
    start = 1577836800  # 2020-01-01 00:00 UTC
    blocks = [
        {"city": "Paris", "time": start - 7200, "time_end": start + 3 * 3600, "interval": 3600,
         "temperature_2m": [1, 2, 3, 4, 5], "relative_humidity_2m": [9] * 5, "snowfall": [0] * 5,
         "precipitation": [0] * 5, "weather_code": [3] * 5},
        {"city": "Lille", "time": start, "time_end": start + 3600, "interval": 3600,
         "temperature_2m": [7], "relative_humidity_2m": [8], "snowfall": [0], "precipitation": [0.5],
         "weather_code": [1]},
    ]
    path = os.path.join(workdir, "blocks.json")
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(b) for b in blocks) + "\n")
    out = weather.fetch_weather(spark, path, "2020-01-01", "2020-01-01").orderBy("city", "date").collect()
    assert [(r["city"], r["temperature_2m"]) for r in out] == [("Lille", 7.0), ("Paris", 3.0), ("Paris", 4.0), ("Paris", 5.0)]
    assert out[0]["latitude"] == 50.6292


def _summer_block(city, hours, values):
    start = 1593558000  # 2020-06-30 23:00 UTC: midnight of the first of July in London
    return {"city": city, "time": start - 3600, "time_end": start - 3600 + hours * 3600, "interval": 3600,
            "temperature_2m": list(range(values)), "relative_humidity_2m": [9] * values, "snowfall": [0] * values,
            "precipitation": [0] * values, "weather_code": [3] * values}


def test_summer_day_has_all_hours_of_the_request_zone(spark, workdir):
    path = os.path.join(workdir, "blocks.json")
    with open(path, "w") as f:
        f.write(json.dumps(_summer_block("Paris", 30, 30)) + "\n")
    out = weather.fetch_weather(spark, path, "2020-07-01", "2020-07-01").collect()
    assert sorted(r["temperature_2m"] for r in out) == [float(t) for t in range(1, 25)]


def test_malformed_block_is_an_error(spark, workdir):
    import pytest
    path = os.path.join(workdir, "blocks.json")
    with open(path, "w") as f:
        f.write(json.dumps(_summer_block("Paris", 30, 29)) + "\n" + json.dumps(_summer_block("Lille", 3, 3)) + "\n")
    with pytest.raises(ValueError, match="Paris"):
        weather.fetch_weather(spark, path, "2020-07-01", "2020-07-01")


def test_archives_from_start_year_stop_at_gap(spark, workdir):
    zdir, land = os.path.join(workdir, "zips"), os.path.join(workdir, "landing")
    os.makedirs(zdir)
    for year in [2011, 2012, 2013, 2015]:
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as z:
            z.writestr(f"data_{year}.xls", b"a;b\n1;2\n")
        with open(os.path.join(zdir, f"Annuel_{year}.zip"), "wb") as f:
            f.write(buf.getvalue())
    got = download_and_extract(spark, zdir, land, start_year=2012).collect()
    assert sorted(r["member"] for r in got) == ["data_2012.xls", "data_2013.xls"]


def test_weather_tables_load_once(spark, workdir):
    from wattline.plans.weather_load import load_cities, load_daily, load_hourly
    blocks, daily, cities = (os.path.join(workdir, n) for n in ("b.json", "d.json", "c.json"))
    with open(blocks, "w") as f:
        f.write(json.dumps(_summer_block("Paris", 30, 30)) + "\n")
    with open(daily, "w") as f:
        for dt in (1, 2, None):
            f.write(json.dumps({"city": "Paris", "latitude": 48.8, "longitude": 2.3,
                                "forecast": json.dumps({"dt": dt, "T": {"min": 1, "max": 2}, "uv": 3})}) + "\n")
    with open(cities, "w") as f:
        f.write(json.dumps({"cities": [{"insee_code": "75056", "label": "paris"}, {"insee_code": "x" * 11}]}, indent=1))
    at = lambda name: os.path.join(workdir, name)
    assert [load_hourly(spark, blocks, "2020-07-01", "2020-07-01", at("h")) for _ in range(2)] == [24, 0]
    assert [load_daily(spark, daily, at("d"), at("dr")) for _ in range(2)] == [
        {"inserted": 2, "rejected": 1}, {"inserted": 0, "rejected": 1}]
    assert [load_cities(spark, cities, at("c"), at("cr")) for _ in range(2)] == [
        {"inserted": 1, "rejected": 1}, {"inserted": 0, "rejected": 1}]
