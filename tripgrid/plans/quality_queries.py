"""Data quality queries."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrid import profiles
from tripgrid.operators import cleaning, quality
from tripgrid.plans import views
from tripgrid.plans.cleaning_queries import sql_faulty
from tripgrid.plans.registry import query
from tripgrid.plans.views import sql_from, sql_mean
from tripgrid.schemas import RAW_TRIP, STANDARD_NAMES
from tripgrid.session import scratch_dir
from tripgrid.sources import fixtures

_TESTS = {
    "coordinates": "in_city",
    "duration": "dur_s BETWEEN 60 AND 10800",
    "distance": "trip_distance BETWEEN 0.1::DOUBLE AND 100",
    "speed": "speed_mph BETWEEN 1 AND 60",
}


def _funnel_sql() -> str:
    steps, tests = ["SELECT 0 AS step, 'raw' AS rule, count(*) AS rows FROM prepared"], []
    for i, (name, test) in enumerate(_TESTS.items(), 1):
        tests.append(f"({test})")
        steps.append(
            f"SELECT {i}, '{name}', count(*) FROM prepared WHERE {' AND '.join(tests)}"
        )
    return "\nUNION ALL ".join(steps)


@query("q01_row_funnel", sql_from("prepared", _funnel_sql()))
def q01(spark, d):
    return quality.row_funnel(fixtures.typed_trips(spark, d))


@query("q02_removal_report", sql_from("prepared", """
SELECT source, initial, initial - c AS coordinates_removed, c - dist AS distance_removed,
  dist - s AS speed_removed, s AS final, round(s * 100.0::DOUBLE / initial, 1) AS retention_percent
FROM (SELECT strftime(pickup_datetime, '%Y-%m') AS source, count(*) AS initial,
    count(*) FILTER (in_city) AS c,
    count(*) FILTER (in_city AND trip_distance > 0 AND trip_distance < 100) AS dist,
    count(*) FILTER (in_city AND trip_distance > 0 AND trip_distance < 100
                     AND raw_speed > 0 AND raw_speed < 60) AS s
  FROM prepared GROUP BY source)"""))
def q02(spark, d):
    return quality.removal_report(fixtures.typed_trips(spark, d))


_QUALITY_COLUMNS = (
    "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance", "fare_amount"
)


# every column of the raw file under its standard name; some can be missing, the rest never are
_ALL_COLUMNS = tuple(
    STANDARD_NAMES.get(n.lower(), n if n in profiles.CLEAN_COLUMNS else n.upper())
    for n in RAW_TRIP.names
)


def _missing_sql(name: str) -> str:
    missing = f"count(*) FILTER ({name} IS NULL)" if name in _QUALITY_COLUMNS else "0::BIGINT"
    return (
        f"SELECT '{name}' AS column_name, {missing} AS missing_count, "
        f"round({missing} * 100.0::DOUBLE / count(*), 2) AS missing_percent FROM faulty"
    )


@query("q03_missing_values", sql_faulty("\nUNION ALL ".join(map(_missing_sql, _ALL_COLUMNS))))
def q03(spark, d):
    """Missing values of every column of the raw file."""
    trips = cleaning.standardize_columns(fixtures.faulty_trips(spark, d))
    report = quality.missing_report(cleaning.parse_datetimes(trips))
    upper = F.upper("column_name")
    kept = F.col("column_name").isin(list(_ALL_COLUMNS))
    return report.withColumn("column_name", F.when(kept, F.col("column_name")).otherwise(upper))


_COORDINATES = ("pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat")


@query("q04_coordinate_ranges", sql_from("raw", "\nUNION ALL ".join(
    f"SELECT '{n}' AS column_name, min({n}) AS min_value, max({n}) AS "
    f"max_value, {sql_mean(n, 6)} AS mean_value FROM raw" for n in _COORDINATES)))
def q04(spark, d):
    trips = cleaning.standardize_columns(fixtures.typed_trips(spark, d))
    return quality.coordinate_report(trips)


@query("q05_coordinate_validity", sql_from("raw", """
SELECT total, valid, total - valid AS invalid, round(valid * 100.0::DOUBLE / total, 1)
    AS valid_percent
FROM (SELECT count(*) AS total, count(*) FILTER (
    pickup_lat BETWEEN 40.4774::DOUBLE AND 40.9176::DOUBLE
    AND pickup_lon BETWEEN -74.2591::DOUBLE AND -73.7004::DOUBLE) AS valid FROM raw)"""))
def q05(spark, d):
    trips = cleaning.standardize_columns(fixtures.typed_trips(spark, d))
    return quality.coordinate_validity(trips, "pickup_lat", "pickup_lon")


@query("q06_file_report", """
SELECT 'lineitem.parquet' AS file_name, count(*) AS records FROM lineitem
UNION ALL SELECT 'orders.parquet', count(*) FROM orders
UNION ALL SELECT 'total', (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM orders)""")
def q06(spark, d):
    """Rows per input file of two tables and in all; sizes are left out, as SQL cannot see them."""
    reports = [quality.file_report(fixtures.table(spark, d, name)) for name in ("lineitem", "orders")]
    return quality.with_total(reports[0].unionByName(reports[1])).select("file_name", "records")


@query("q06_file_sizes", """
SELECT true AS total_is_the_sum, count(*) > 0 AS sized, 4::BIGINT AS files FROM lineitem""")
def q06_sizes(spark, d):
    """Sizes of the files of four tables add up to the total row."""
    reports = [
        quality.file_report(fixtures.table(spark, d, name))
        for name in ("lineitem", "orders", "part", "customer")
    ]
    report = quality.with_total(reduce(DataFrame.unionByName, reports))
    total = F.col("file_name") == "total"
    return report.agg(
        (
            F.sum(F.when(total, F.col("size_bytes"))) == F.sum(F.when(~total, F.col("size_bytes")))
        ).alias("total_is_the_sum"),
        F.bool_and(F.col("size_bytes") > 0).alias("sized"),
        F.count_if(~total).alias("files"),
    )


# the clean table's schema as data, with the type names of the session
_CLEAN_SCHEMA = [
    (i, n, {"pickup_datetime": "timestamp", "dropoff_datetime": "timestamp", "cell_id": "string",
            "is_manhattan": "boolean"}.get(n, "double" if n in (
                "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon", "trip_distance",
                "duration_hours", "speed_mph", "fare_amount", "total_amount") else "int"))
    for i, n in enumerate(profiles.CLEAN_COLUMNS, 1)
]


@query("q07_schema_table", sql_from("clean", "\nUNION ALL ".join(
    f"SELECT {i} AS position, '{n}' AS column_name, '{t}' AS data_type, "
    f"count(*) FILTER ({n} IS NULL) AS missing_count FROM clean" for i, n, t in _CLEAN_SCHEMA)))
def q07(spark, d):
    """Schema of the clean table beside the missing count of each of its columns."""
    trips = views.clean(spark, d)
    counts = quality.missing_report(trips).select("column_name", "missing_count")
    return quality.schema_table(trips).join(counts, "column_name").orderBy(F.col("position"))


@query("p16_required_columns", """
SELECT 'complete' AS kind, '' AS message, count(*) AS rows FROM lineitem
UNION ALL SELECT 'incomplete', 'missing required columns: dropoff_datetime, trip_distance', 0""")
def p16(spark, d):
    """A complete table passes with all its rows, an incomplete one names what it lacks."""
    trips = cleaning.standardize_columns(fixtures.typed_trips(spark, d))
    passed = cleaning.require_columns(trips).agg(F.count(F.lit(1)).alias("rows"))
    try:
        cleaning.require_columns(trips.drop("trip_distance", "dropoff_datetime"))
        message = ""
    except ValueError as lacking:
        message = str(lacking)
    complete = passed.select(F.lit("complete").alias("kind"), F.lit("").alias("message"), "rows")
    return complete.unionByName(
        spark.createDataFrame([("incomplete", message, 0)], "kind string, message string, rows bigint")
    )


@query("s10_storage_target", """
SELECT 'qualified' AS path, count(*) AS rows FROM orders
UNION ALL SELECT 'unqualified', count(*) FROM orders""")
def s10(spark, d):
    """A path with its filesystem named, and the same one on the session's default filesystem."""
    path = scratch_dir(spark, "target")
    fixtures.table(spark, d, "orders").write.parquet(path)
    plain = re.sub(r"^file:/+", "/", path)
    full = plain if "://" in plain else f"file://{plain}"
    counted = [
        spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("path"), "rows")
        for n, p in (("qualified", full), ("unqualified", plain))
    ]
    return counted[0].unionByName(counted[1])
