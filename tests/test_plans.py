"""Plans keep the shape that scales: pushed filters, pruned columns, few shuffles."""

import pytest

from tests.conftest import SMALL
from tripgrid.operators import aggregates, features, joins
from tripgrid.operators.cleaning import clean_trips
from tripgrid.plans import catalog, views
from tripgrid.sources import fixtures, sinks
from tripgrid.streaming import windows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def details(df) -> str:
    """The formatted plan, whose filter lists are not cut short."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "trips")
    sinks.write_parquet(fixtures.raw_trips(spark, SMALL), path)
    return spark.read.parquet(path)


def test_cleaning_is_one_stage_with_pushed_filters(raw):
    text = plan(clean_trips(raw))
    assert "Exchange" not in text
    assert "PushedFilters: [IsNotNull(pickup_latitude)" in text
    assert text.count("RLIKE") == 2  # each time is parsed once


def test_pickup_time_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "typed")
    sinks.write_parquet(fixtures.typed_trips(spark, SMALL), path)
    typed = spark.read.parquet(path)
    for df in (
        clean_trips(typed, since="2016-02-01", until="2016-03-01"),
        clean_trips(typed).filter("pickup_datetime >= '2016-02-01'"),
    ):
        assert "GreaterThanOrEqual(tpep_pickup_datetime,2016-02-01" in details(df)


def test_test_trips_read_only_needed_columns(spark):
    text = plan(catalog.queries()["a07_trips_by_hour"](spark, SMALL))
    assert "l_tax" not in text and "l_extendedprice" not in text


def test_live_state_never_sorts_events(spark):
    text = plan(windows.live_state(views.gps(spark, SMALL)))
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_jobs_write_by_month(spark, tmp_path):
    trips = clean_trips(fixtures.typed_trips(spark, SMALL))
    sinks.write_parquet(trips, str(tmp_path / "clean"), compact=True, partition_by=("year", "month"))
    text = plan(spark.read.parquet(str(tmp_path / "clean")).filter("year = 2016 AND month = 2"))
    assert "PartitionFilters: [isnotnull(year" in text and "(month" in text


def test_scan_reads_only_needed_columns(raw):
    text = plan(clean_trips(raw).groupBy("hour").count())
    schema = text[text.index("ReadSchema"):]
    assert "fare_amount" not in schema and "VendorID" not in schema


def test_cell_hour_aggregates_before_its_only_shuffle(raw):
    text = plan(aggregates.cell_hour(clean_trips(raw)))
    assert text.count("Exchange") == 1 and "partial_sum" in text


def test_history_reuses_the_shuffle_of_the_lags(raw):
    text = plan(features.feature_table(aggregates.with_labels(aggregates.cell_hour(clean_trips(raw)))))
    assert text.count("Exchange hashpartitioning") == 2


def test_landmark_list_needs_no_join(raw):
    df = raw.select(joins.landmark_name("pickup_latitude", "pickup_longitude").alias("z"))
    assert "Join" not in plan(df) and "Exchange" not in plan(df)


def test_zone_table_joins_on_tiles(spark):
    text = plan(joins.match_zones(
        views.traffic_state(spark, SMALL), joins.landmark_table(spark)))
    assert "NestedLoop" not in text and "Cartesian" not in text


@pytest.mark.parametrize("name", [
    n for n in sorted(catalog.oracle_sql()) if n[0] in "aptlwd" and "stream" not in n
])
def test_no_python_and_no_cross_join_in_plans(spark, name):
    text = plan(catalog.queries()[name](spark, SMALL))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Pandas"):
        assert word not in text
