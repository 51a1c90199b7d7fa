"""Boundary rows of the cleaning rules and expressions."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tripgrid import profiles
from tripgrid.functions import grid, labels, temporal
from tripgrid.operators import cleaning, quality
from tripgrid.schemas import RAW_TRIP
from tripgrid.sources import files, fixtures

START = dt.datetime(2016, 1, 4, 8, 0)
SCHEMA = """pickup_datetime string, dropoff_datetime string, pickup_lat double, pickup_lon double,
    dropoff_lat double, dropoff_lon double, trip_distance double, passenger_count int,
    fare_amount double, total_amount double"""


def trip(seconds=600, distance=2.0, lat=40.75, lon=-73.98, passengers=1, pickup=None, dropoff=None):
    end = START + dt.timedelta(seconds=seconds)
    return (
        pickup or START.isoformat(" "), dropoff or end.isoformat(" "), lat, lon, 40.75, -73.98,
        distance, passengers, 10.0, 12.0,
    )


def kept(spark, rows, profile=profiles.STANDARD):
    return cleaning.clean_trips(spark.createDataFrame(rows, SCHEMA), profile).collect()


@pytest.mark.parametrize("seconds, distance, passes", [
    (59, 0.5, False), (60, 0.5, True), (10800, 50.0, True), (10801, 50.0, False),
    (0, 0.5, False), (-600, 2.0, False),
])
def test_duration_bounds(spark, seconds, distance, passes):
    assert bool(kept(spark, [trip(seconds, distance)])) == passes


@pytest.mark.parametrize("distance, profile, passes", [
    (0.09, "standard", False), (0.1, "standard", True), (100.0, "standard", True),
    (100.1, "standard", False), (0.1, "v1", False), (100.0, "v1", False), (0.05, "v2", True),
    (0.0, "v2", False),
])
def test_distance_bounds(spark, distance, profile, passes):
    seconds = max(60, int(distance * 3600 / 40))
    rows = kept(spark, [trip(seconds, distance)], profiles.CLEAN_PROFILES[profile])
    assert bool(rows) == passes


@pytest.mark.parametrize("distance, seconds, passes", [
    (1.0, 3600, True), (0.99, 3600, False), (60.0, 3600, True), (60.01, 3600, False),
])
def test_speed_bounds(spark, distance, seconds, passes):
    assert bool(kept(spark, [trip(seconds, distance)])) == passes


@pytest.mark.parametrize("lat, lon, passes", [
    (40.4774, -73.98, True), (40.4773, -73.98, False), (40.9176, -73.98, True),
    (40.9177, -73.98, False), (40.75, -74.2591, True), (40.75, -74.2592, False),
    (40.75, -73.7004, True), (40.75, -73.7003, False),
])
def test_box_edges(spark, lat, lon, passes):
    assert bool(kept(spark, [trip(lat=lat, lon=lon)])) == passes


def test_unparsable_and_missing_dates_are_dropped(spark):
    rows = [trip(), trip(pickup="not-a-date"), trip(pickup="2016-01-04T08:00:00"),
            trip(dropoff="2016-02-30 08:00:00"), (None, *trip()[1:])]
    assert len(kept(spark, rows)) == 1


@pytest.mark.parametrize("text", [
    "2016-02-29 23:59:59", "2016-02-30 00:00:00", "2016-01-01 24:00:00", "2016-01-01T00:00:00",
    "2016-1-01 00:00:000", "2016-01-01 00:00:0Z", "2016-01-01", "", "x", " 2016-01-01 00:00:00",
])
def test_fast_parse_equals_the_format_parser(spark, text):
    df = spark.createDataFrame([(text,)], "pickup_datetime string").withColumn(
        "slow", F.try_to_timestamp("pickup_datetime", F.lit("yyyy-MM-dd HH:mm:ss"))
    )
    row = cleaning.parse_datetimes(df, ("pickup_datetime",)).first()
    assert row["pickup_datetime"] == row["slow"]


def test_documented_grid_example(spark):
    df = spark.createDataFrame([(40.7580, -73.9855)], "pickup_lat double, pickup_lon double")
    assert grid.with_cell(df, profiles.STANDARD.grid).first()["cell_id"] == "cell_28_27"


def test_cell_id_parse(spark):
    df = spark.createDataFrame([("cell_28_27",), ("28_27",), ("x",), (None,)], "c string")
    lat, lon = grid.parse_cell_id("c")
    assert [tuple(r) for r in df.select(lat, lon).collect()] == [
        (28, 27), (28, 27), (None, None), (None, None)
    ]


@pytest.mark.parametrize("speed, expected", [
    (7.99, ("High", "high", "High", "High")), (8.0, ("High", "high", "High", "Medium")),
    (9.99, ("High", "high", "High", "Medium")), (10.0, ("Medium", "high", "Medium", "Medium")),
    (15.0, ("Medium", "medium", "Medium", "Low")), (20.0, ("Medium", "medium", "Low", "Low")),
    (20.01, ("Low", "low", "Low", "Low")),
])
def test_label_edges(spark, speed, expected):
    rules = (profiles.LABELS, profiles.LABELS_LEGACY, profiles.LABELS_COMPACT,
             profiles.LABELS_WINDOW)
    columns = [
        labels.level_name(labels.congestion_label(F.lit(speed), r), r).alias(f"c{i}")
        for i, r in enumerate(rules)
    ]
    assert tuple(spark.range(1).select(*columns).first()) == expected


@pytest.mark.parametrize("hour, rush, night, night_v1", [
    (5, 0, 1, 1), (6, 0, 1, 0), (7, 1, 0, 0), (9, 1, 0, 0), (10, 0, 0, 0), (17, 1, 0, 0),
    (19, 1, 0, 0), (20, 0, 0, 0), (22, 0, 1, 1),
])
def test_time_flags(spark, hour, rush, night, night_v1):
    h = F.lit(hour)
    row = spark.range(1).select(
        temporal.is_rush_hour(h), temporal.is_night(h),
        temporal.is_night(h, profiles.NIGHT_END_LEGACY),
    ).first()
    assert tuple(row) == (rush, night, night_v1)


def test_weekday_conventions(spark):
    days = [dt.datetime(2016, 1, 2), dt.datetime(2016, 1, 3), dt.datetime(2016, 1, 4)]
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp")
    columns = []
    for w in ("sunday1", "monday0", "monday1"):
        number = temporal.day_number("ts", w)
        columns += [number.alias(w), temporal.is_weekend(number, w).alias(f"{w}_weekend")]
    assert [tuple(r) for r in df.select(*columns).collect()] == [
        (7, 1, 5, 1, 6, 1), (1, 1, 6, 1, 7, 1), (2, 0, 0, 0, 1, 0)
    ]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="trip_distance"):
        cleaning.require_columns(spark.createDataFrame([trip()], SCHEMA).drop("trip_distance"))


def test_malformed_csv_lines_are_dropped(spark, tmp_path):
    good = "1,2016-01-04 08:00:00,2016-01-04 08:10:00,1,2.0,-73.98,40.75,1,N,-73.98,40.75,1," \
           "10.0,0,0,0,0,0,12.0"
    bad = good.replace("2.0", "two")
    (tmp_path / "a.csv").write_text("\n".join([",".join(RAW_TRIP.names), good, bad]))
    assert len(files.read_raw_csv(spark, str(tmp_path)).collect()) == 1


def test_fixture_counts(spark):
    trips = fixtures.typed_trips(spark, SMALL)
    clean = cleaning.clean_trips(trips)
    assert (trips.count(), clean.count()) == (6000, 4979)
    assert clean.columns == list(profiles.CLEAN_COLUMNS)
    funnel = [r["rows"] for r in quality.row_funnel(trips).collect()]
    assert funnel == sorted(funnel, reverse=True) and funnel[-1] == 4979


def test_goldens_of_the_published_statistics(spark):
    row = cleaning.clean_trips(fixtures.typed_trips(spark, SMALL)).agg(
        F.min("speed_mph"), F.max("speed_mph"), F.min("duration_hours"), F.max("duration_hours"),
        F.min("cell_lat"), F.max("cell_lat"), F.min("cell_lon"), F.max("cell_lon"),
    ).first()
    assert row[0] >= 1 and row[1] <= 60 and row[2] >= 1 / 60 and row[3] <= 3
    assert row[4] >= 0 and row[5] <= 44 and row[6] >= 0 and row[7] <= 55


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 2500), min_size=1, max_size=20))
def test_label_never_rises_with_speed(spark, hundredths):
    df = spark.createDataFrame([(h / 100,) for h in sorted(hundredths)], "s double")
    found = [r[0] for r in df.select(labels.congestion_label("s")).collect()]
    assert found == sorted(found, reverse=True)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 44), st.integers(0, 55))
def test_cell_of_its_own_centre(spark, i, j):
    g = profiles.STANDARD.grid
    lat, lon = g.origin_lat + (i + 0.5) * g.size, g.origin_lon + (j + 0.5) * g.size
    row = spark.range(1).select(
        grid.cell_index(F.lit(lat), g.origin_lat, g.size),
        grid.cell_index(F.lit(lon), g.origin_lon, g.size),
    ).first()
    assert tuple(row) == (i, j)
