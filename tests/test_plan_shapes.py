"""Plan properties that matter at scale, checked on the physical plan."""

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_one_exchange_with_partial_aggregate(spark):
    plan = _plan(spark, "agg_10")
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "partial_min_by" in plan                   # combined map-side before the shuffle


def test_first_values_read_as_numbers_sort_no_raw_rows(spark):
    for name in ("agg_10", "agg_10_wide"):
        plan = _plan(spark, name)
        assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_time_is_parsed_once_a_row(spark):
    """No filter on the parsed hour below the grouping: it would parse every row's time again."""
    for name in ("agg_10", "agg_03", "final_features"):
        for line in _plan(spark, name).splitlines():
            assert not re.search(r"Filter .*try_cast", line), name


def test_hourly_mean_is_hash_aggregate(spark):
    plan = _plan(spark, "agg_01")
    assert "HashAggregate" in plan and "partial_avg" in plan


def test_year_filter_prunes_partitions(spark):
    assert re.search(r"PartitionFilters: \[.*year", _plan(spark, "snk_08"))


def test_knn_partial_top_k_before_shuffle(spark):
    plan = _plan(spark, "ml_04")
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_anti_join_reads_only_stored_key_columns(spark):
    plan = _plan(spark, "jon_01")
    assert "LeftAnti" in plan
    # the stored side scan keeps the filter on event type and reads no value column
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>", plan)


def test_dimension_join_is_broadcast(spark):
    assert "BroadcastHashJoin" in _plan(spark, "src_10")


def test_no_cross_products_anywhere(spark):
    for name in E.oracle_sql():
        if name.startswith(("snk_", "src_01", "src_07")):
            continue  # these write tables as part of building the frame
        plan = _plan(spark, name)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_lookups_push_their_keys_to_the_scan(spark):
    def formatted(name):
        df = E.queries()[name](spark, SF)
        return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")

    assert re.search(r"PushedFilters: \[.*EqualTo\(date,2024-01-01\)", formatted("flt_01"))
    assert re.search(r"PushedFilters: \[.*EqualTo\(db_id,user_8_2024-01-01_00:00\)", formatted("flt_02"))
