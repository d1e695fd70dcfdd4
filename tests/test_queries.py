"""Every registered query that has a DuckDB twin, at sf0.001: same columns,
same multiset of rows (doubles compared to 9 significant digits)."""

import pytest

import __spark_entry__ as E
from check_oracle import compare, duck

SF = "/root/testdata/sf0.001"
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(n for n in ORACLE if not n.startswith("op") and n != "pipeline"))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], ORACLE[name], SF)
    assert r["cols_equal"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["rounded"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"consommation", "hour", "day", "month", "dayofweek", "weekend"}
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_a_model_fit():
    rows_only = {q for q in set(E.queries()) - set(ORACLE) if not q.startswith("op") and q != "pipeline"}
    assert rows_only == {"ml_03", "ml_05"}
