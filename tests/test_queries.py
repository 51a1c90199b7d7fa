"""Every registered query against its SQL twin, or for rows only."""

import pytest

import __spark_entry__ as entry_point
from tests.conftest import SMALL
from tests.oracle import connect, differences

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_rows(spark, name):
    assert QUERIES[name](spark, SMALL).limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[:3] == ["cell_id", "cell_lat", "cell_lon"]
    assert df.count() == 4648


def test_global_sort_is_in_order(spark):
    rows = [(-r["c_acctbal"], r["c_custkey"]) for r in
            QUERIES["o01_global_sort"](spark, SMALL).collect()]
    assert rows == sorted(rows)
