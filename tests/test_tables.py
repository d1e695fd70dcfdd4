import os

import pytest
from pyspark.sql import functions as F

from wattline.operators import clean, tables
from wattline.contracts import CONSUMPTION_TABLE_SCHEMA, WEATHER_DAILY_SCHEMA

SCHEMA = "k1 string, k2 string, v long, ord long"


def test_insert_if_absent_idempotent(spark, workdir):
    path = os.path.join(workdir, "t")
    batch = spark.createDataFrame([("a", "x", 1, 0), ("a", "x", 2, 1), (None, "y", 3, 2), ("b", "x", 4, 3)], SCHEMA)
    first = tables.insert_if_absent(spark, path, batch, ["k1", "k2"], ["ord"])
    assert sorted(r["v"] for r in first.collect()) == [1, 3, 4]          # first duplicate wins
    again = tables.insert_if_absent(spark, path, batch, ["k1", "k2"], ["ord"])
    assert again.count() == 0                                            # null key matches null key
    assert spark.read.parquet(path).count() == 3


def test_insert_without_return_is_idempotent(spark, workdir):
    path = os.path.join(workdir, "t")
    batch = spark.createDataFrame([("a", "x", 1, 0), ("a", "x", 2, 1), ("b", "x", 4, 3)], SCHEMA)
    assert tables.insert_if_absent(spark, path, batch, ["k1", "k2"], ["ord"], return_inserted=False) > 0
    tables.insert_if_absent(spark, path, batch, ["k1", "k2"], ["ord"], return_inserted=False)
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 4]


def test_create_table_if_absent_keeps_existing(spark, workdir):
    path = os.path.join(workdir, "c")
    t = tables.create_table_if_absent(spark, path, CONSUMPTION_TABLE_SCHEMA)
    assert len(t.columns) == 40 and t.count() == 0
    tables.append(spark.createDataFrame([("x",) + (None,) * 39], CONSUMPTION_TABLE_SCHEMA), path)
    again = tables.create_table_if_absent(spark, path, CONSUMPTION_TABLE_SCHEMA)
    assert again.count() == 1


def test_create_table_by_many_at_once(spark, workdir, monkeypatch):
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier
    started, read = Barrier(6), tables.read_table

    def read_together(*args):
        found = read(*args)
        started.wait(60)
        return found

    monkeypatch.setattr(tables, "read_table", read_together)
    for k in range(3):
        path = os.path.join(workdir, f"many{k}")
        with ThreadPoolExecutor(6) as pool:
            made = list(pool.map(lambda _: tables.create_table_if_absent(spark, path, WEATHER_DAILY_SCHEMA), range(6)))
        assert all(t.columns == WEATHER_DAILY_SCHEMA.names and t.count() == 0 for t in made)
        assert spark.read.parquet(path).columns == WEATHER_DAILY_SCHEMA.names


def test_validity_split(spark):
    raw = spark.createDataFrame([("1",), ("1.0",), ("1.5",), ("3000000000",), ("12d",), (None,)], "c string")
    valid, rejected = tables.split_valid(raw, clean.reject_reasons(raw, ["c"]))
    assert sorted((r["c"] or "") for r in valid.collect()) == ["", "1", "1.0", "12d"]
    reasons = {r["c"]: list(r["reasons"]) for r in rejected.collect()}
    assert reasons == {"1.5": ["c:fraction"], "3000000000": ["c:int32"]}


def test_not_null_and_length(spark):
    df = spark.createDataFrame([("a", None), ("toolongvalue", 1)], "s string, dt long")
    v, r = tables.split_valid(df, F.concat(tables.length_violations([("s", 5)]), tables.null_violations(["dt"])))
    assert v.count() == 0
    assert sorted(list(x["reasons"]) for x in r.collect()) == [["dt:null"], ["s:length>5"]]


def test_union_by_name_order(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    u = tables.union_by_name([a, b])
    assert u.columns == ["a", "b", "c"] and u.count() == 2


def test_partitioned_write_prunes(spark, workdir):
    path = os.path.join(workdir, "p")
    df = spark.createDataFrame([(1, 2020), (2, 2021)], "v int, year int")
    tables.append(df, path, partition_by=["year"])
    q = spark.read.parquet(path).where(F.col("year") == 2021)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and q.count() == 1


def test_weather_daily_contract(spark, workdir):
    t = tables.create_table_if_absent(spark, os.path.join(workdir, "w"), WEATHER_DAILY_SCHEMA)
    assert t.columns[0] == "db_id" and len(t.columns) == 15


def test_unknown_year_is_inserted_once(spark, workdir):
    path = os.path.join(workdir, "by_year")
    batch = spark.createDataFrame([("x", None, 1), ("y", 2020, 2), (None, None, 3)], "k string, year int, ord int")
    counts = [tables.insert_if_absent(spark, path, batch, ["k"], ["ord"], partition_by=["year"], return_inserted=False)
              for _ in range(3)]
    assert counts == [3, 0, 0]


def test_reasons_beyond_64_bits(spark):
    rows = [("9223372036854775808",), ("inf",), ("1.5",), ("3000000000",), ("7",), ("1e30",)]
    df = spark.createDataFrame(rows, "c string")
    got = {r["c"]: r["why"] for r in df.select("c", clean.reject_reasons(df, ["c"]).alias("why")).collect()}
    assert got == {"9223372036854775808": ["c:int64"], "inf": ["c:int64"], "1.5": ["c:fraction"],
                   "3000000000": ["c:int32"], "7": [], "1e30": ["c:int64"]}


def test_session_keeps_the_clusters_settings(spark):
    from wattline.session import get_session
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "4000")
        assert get_session().conf.get("spark.sql.shuffle.partitions") == "4000"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


ROWS_SCHEMA = "k string, d date, v int, ord long"


def _rows(spark, keys, tag):
    import datetime as dt
    return spark.createDataFrame([(f"k{k:04d}", dt.date(2020, 1, 1) + dt.timedelta(days=k % 300), tag, k) for k in keys], ROWS_SCHEMA)


def _insert(spark, path, batch, **kw):
    return tables.insert_if_absent(spark, path, batch, ["k", "d"], ["ord"], return_inserted=False, **kw)


def test_two_loads_at_once_leave_each_key_once(spark, workdir):
    from concurrent.futures import ThreadPoolExecutor

    from wattline.operators import commits
    path = os.path.join(workdir, "t")
    _insert(spark, path, _rows(spark, range(20), 0))
    batches = [_rows(spark, range(10 * i, 10 * i + 80), i + 1) for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(lambda b: _insert(spark, path, b), batches))
    stored = spark.read.parquet(path).collect()
    assert len(stored) == len({r["k"] for r in stored}) == 110 and sum(counts) == 90
    log = commits.Log(spark, path)
    assert log.numbers() == list(range(1, 2 + sum(c > 0 for c in counts))) and log._listed(f"{path}/_staged") == []


def test_a_lost_claim_looks_again(spark, workdir, monkeypatch):
    """Between a load's anti join and its claim another load commits: only what is still absent goes in."""
    from wattline.operators import commits
    path = os.path.join(workdir, "t")
    claim, between = commits.Log.claim, [True]

    def late(self, *args):
        if between:
            between.clear()
            assert _insert(spark, path, _rows(spark, range(50, 150), 2)) == 100
        return claim(self, *args)

    monkeypatch.setattr(commits.Log, "claim", late)
    assert _insert(spark, path, _rows(spark, range(100), 1)) == 50
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect()) == [
        (f"k{k:04d}", 1 if k < 50 else 2) for k in range(150)]


def test_a_load_that_dies_after_its_claim_is_finished_by_the_next(spark, workdir, monkeypatch):
    from wattline.operators import commits
    path = os.path.join(workdir, "t")
    finish = commits.Log.finish
    monkeypatch.setattr(commits.Log, "finish", lambda self, claim: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        _insert(spark, path, _rows(spark, range(30), 1))
    assert spark.read.parquet(path).count() == 0
    monkeypatch.setattr(commits.Log, "finish", finish)
    assert _insert(spark, path, _rows(spark, range(20, 40), 2)) == 10
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1] * 30 + [2] * 10


def test_files_that_cannot_hold_a_key_are_not_read(spark, workdir, monkeypatch):
    path = os.path.join(workdir, "t")
    for start in (0, 100, 200):
        _insert(spark, path, _rows(spark, range(start, start + 60), start))
    tables.append(_rows(spark, range(900, 905), 9).drop("ord"), path)           # no claim names these files
    read = []
    was = tables._stored_files

    def seen(*args):
        found = was(*args)
        read.append({r["v"] for r in found.collect()})
        return found

    monkeypatch.setattr(tables, "_stored_files", seen)
    assert _insert(spark, path, _rows(spark, range(110, 170), 7)) == 10
    assert _insert(spark, path, _rows(spark, range(900, 907), 7)) == 2
    assert read == [{100, 9}, {9}]
    nulls = spark.createDataFrame([(None, None, 1, 1)], ROWS_SCHEMA)
    assert [_insert(spark, path, nulls) for _ in range(2)] == [1, 0]
    assert spark.read.parquet(path).count() == 198


def test_partitioned_commits(spark, workdir):
    path = os.path.join(workdir, "t")
    batch = lambda keys, tag: _rows(spark, keys, tag).withColumn("year", F.year("d") + F.col("ord").cast("int") % 2)
    for keys, want in ((range(40), 40), (range(20, 60), 20), (range(60), 0)):
        assert _insert(spark, path, batch(keys, 1), partition_by=["year"]) == want
    assert sorted(r["year"] for r in spark.read.parquet(path).groupBy("year").count().collect()) == [2020, 2021]


def test_a_cell_that_does_not_cast_is_set_aside(spark, workdir):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.IntegerType())])
    batch = spark.createDataFrame([("a", "1", 1), ("b", "x", 2), ("c", None, 3), ("a", "2", 4)], "k string, n string, ord long")
    path, bad = os.path.join(workdir, "t"), os.path.join(workdir, "bad")
    assert tables.insert_if_absent(spark, path, batch, ["k"], ["ord"], schema, return_inserted=False, rejected_path=bad) == 2
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 1), ("c", None)]
    assert [(r["k"], r["n"], list(r["reasons"])) for r in spark.read.parquet(bad).collect()] == [("b", "x", ["n:cast"])]


def test_ranges():
    from wattline.operators.commits import overlap
    r = lambda lo, hi, nulls=False: {"k": [lo and ["str", lo], hi and ["str", hi], nulls]}
    assert overlap(r("a", "f"), r("f", "z"), ["k"]) and not overlap(r("a", "f"), r("g", "z"), ["k"])
    assert not overlap(r(None, None, True), r("a", "b"), ["k"]) and overlap(r("a", "b", True), r("c", "d", True), ["k"])
    assert overlap(None, r("a", "b"), ["k"]) and overlap({"k": [["int", 1], ["int", 2], False]}, r("a", "b"), ["k"])
    assert not overlap(r("a", "z"), r("é", "ü"), ["k"]) and overlap(r("a", "ÿ"), r("é", "ü"), ["k"])
