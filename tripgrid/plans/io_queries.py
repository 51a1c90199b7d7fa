"""Source and sink queries: what is written must come back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripgrid import profiles
from tripgrid.operators import aggregates, analysis, cleaning, features, quality
from tripgrid.plans import views
from tripgrid.plans.registry import query, rounded
from tripgrid.plans.views import sql_from
from tripgrid.session import scratch_dir
from tripgrid.sources import files, fixtures, sinks

_RAW_SQL = """
SELECT vendor_id AS "VendorID",
  strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS tpep_pickup_datetime,
  strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS tpep_dropoff_datetime,
  passenger_count, trip_distance, pickup_lon AS pickup_longitude, pickup_lat AS pickup_latitude,
  1 AS "RatecodeID", 'N' AS store_and_fwd_flag, dropoff_lon AS dropoff_longitude,
  dropoff_lat AS dropoff_latitude, passenger_count AS payment_type, fare_amount,
  0.0::DOUBLE AS extra, 0.0::DOUBLE AS mta_tax, 0.0::DOUBLE AS tip_amount,
  0.0::DOUBLE AS tolls_amount, 0.0::DOUBLE AS improvement_surcharge, total_amount FROM raw"""


def _csv_folder(spark, d) -> str:
    folder = f"{scratch_dir(spark, 'csv')}/trips_2016.csv"
    sinks.write_csv(fixtures.raw_trips(spark, d), folder)
    return folder


@query("s01_csv_scan", sql_from("raw", _RAW_SQL))
def s01(spark, d):
    return files.read_raw_csv(spark, _csv_folder(spark, d))


_INFERRED_SQL = """
SELECT vendor_id AS "VendorID", pickup_datetime AS tpep_pickup_datetime,
  dropoff_datetime AS tpep_dropoff_datetime, passenger_count, trip_distance,
  pickup_lon AS pickup_longitude, pickup_lat AS pickup_latitude, 1 AS "RatecodeID",
  'N' AS store_and_fwd_flag, dropoff_lon AS dropoff_longitude, dropoff_lat AS dropoff_latitude,
  passenger_count AS payment_type, fare_amount, 0.0::DOUBLE AS extra, 0.0::DOUBLE AS mta_tax,
  0.0::DOUBLE AS tip_amount, 0.0::DOUBLE AS tolls_amount,
  0.0::DOUBLE AS improvement_surcharge, total_amount FROM raw"""


@query("s02_csv_infer", sql_from("raw", _INFERRED_SQL))
def s02(spark, d):
    """All 19 columns with the types found in the text."""
    return files.read_csv_inferred(spark, _csv_folder(spark, d))


@query("s04_csv_name_filter", sql_from("raw", """
SELECT passenger_count, count(*) AS row_count FROM raw GROUP BY passenger_count"""))
def s04(spark, d):
    """Files picked by folder glob and name filter."""
    folder = _csv_folder(spark, d)
    trips = files.read_raw_csv(spark, folder.replace("trips_2016", "trips_*"), "part-*.csv")
    return trips.groupBy("passenger_count").agg(F.count(F.lit(1)).alias("row_count"))


def _monthly_tables(spark, d) -> str:
    folder = scratch_dir(spark, "clean")
    trips = views.clean(spark, d)
    for year, month in trips.select("year", "month").distinct().collect():
        part = trips.filter((F.col("year") == year) & (F.col("month") == month))
        sinks.write_parquet(part, f"{folder}/trips_{year}-{month:02d}_clean.parquet")
    return folder


_CLEAN_COUNTS = """
SELECT month, count(*) AS row_count, count(DISTINCT cell_id) AS cells FROM clean GROUP BY month"""


@query("s05_parquet_glob", sql_from("clean", _CLEAN_COUNTS))
def s05(spark, d):
    trips = files.read_clean(spark, f"{_monthly_tables(spark, d)}/*_clean.parquet")
    return trips.groupBy("month").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("cell_id").alias("cells")
    )


@query("s06_feature_scan", sql_from("features", "SELECT * FROM features"))
def s06(spark, d):
    path = scratch_dir(spark, "features")
    sinks.write_parquet(views.feature_rows(spark, d), path)
    table, names = files.read_features(spark, path)
    return table.select(
        *names, *profiles.TARGET_COLUMNS, *profiles.METADATA_COLUMNS, "dataset_split"
    )


@query("s07_head_sample", sql_from("raw", """
SELECT pickup_datetime, trip_distance, pickup_lat, pickup_lon FROM raw
ORDER BY pickup_datetime, trip_distance, pickup_lat, pickup_lon LIMIT 100000"""))
def s07(spark, d):
    columns = ["pickup_datetime", "trip_distance", "pickup_lat", "pickup_lon"]
    trips = cleaning.standardize_columns(fixtures.typed_trips(spark, d)).select(*columns)
    minute = F.date_trunc("minute", F.col("pickup_datetime"))
    return analysis.smallest_rows(trips, 100_000, columns, minute)


_CLEAN_SAMPLE = "SELECT pickup_datetime, cell_id, speed_mph, trip_distance FROM clean"
_SAMPLE_COLUMNS = ("pickup_datetime", "cell_id", "speed_mph", "trip_distance")


@query("k01_parquet_sized", sql_from("clean", _CLEAN_SAMPLE))
def k01(spark, d):
    path = scratch_dir(spark, "sized")
    sinks.write_parquet(views.clean(spark, d), path, sinks.ROWS_PER_FILE, compact=True)
    return files.read_clean(spark, path).select(*_SAMPLE_COLUMNS)


@query("k02_parquet_plain", sql_from("clean", _CLEAN_SAMPLE))
def k02(spark, d):
    path = scratch_dir(spark, "plain")
    sinks.write_parquet(views.clean(spark, d), path)
    return files.read_clean(spark, path).select(*_SAMPLE_COLUMNS)


@query("k03_copy_table", sql_from("clean", _CLEAN_SAMPLE))
def k03(spark, d):
    path = scratch_dir(spark, "copy")
    sinks.write_parquet(views.clean(spark, d), f"{path}/source")
    sinks.copy_table(spark, f"{path}/source", f"{path}/target")
    return files.read_clean(spark, f"{path}/target").select(*_SAMPLE_COLUMNS)


_NOT_NUMERIC = ("pickup_datetime", "dropoff_datetime", "cell_id", "is_manhattan")
_EXPORTED = tuple(n for n in profiles.CLEAN_COLUMNS if n not in _NOT_NUMERIC)


@query("k04_readable_statistics", sql_from("clean", "\nUNION ALL ".join(
    f"SELECT '{n}' AS column_name, count({n})::INT AS count, round(avg({n}::DOUBLE), 4) AS mean, "
    f"round(min({n})::DOUBLE, 4) AS min, round(max({n})::DOUBLE, 4) AS max FROM clean"
    for n in _EXPORTED)))
def k04(spark, d):
    """Statistics of every numeric column of the clean table."""
    folder = scratch_dir(spark, "readable")
    sinks.readable_export(views.clean(spark, d), folder, full=False)
    written = files.read_csv_inferred(spark, f"{folder}/statistics")
    return rounded(written.select("column_name", "count", "mean", "min", "max"))


@query("k04_readable_full", sql_from("clean", """
SELECT count(*) AS row_count, count(DISTINCT cell_id) AS cells,
  sum(floor(speed_mph * 100.0::DOUBLE + 0.5::DOUBLE)::BIGINT)::BIGINT AS hundredths FROM clean"""))
def k04_full(spark, d):
    """The full copy of a table of any length, read back."""
    folder = scratch_dir(spark, "readable")
    sinks.readable_export(views.clean(spark, d), folder)
    return files.read_csv_inferred(spark, f"{folder}/full").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("cell_id").alias("cells"),
        F.sum(F.floor(F.col("speed_mph") * 100.0 + 0.5)).alias("hundredths"),
    )


@query("k04_readable_sample", sql_from("clean", """
SELECT least(1000, count(*)) AS sampled, 0::BIGINT AS strangers FROM clean"""))
def k04_sample(spark, d):
    """How many rows the sample has, and how many of them the table does not have."""
    folder = scratch_dir(spark, "readable")
    keys = ["pickup_datetime", "dropoff_datetime", "cell_id", "fare_amount"]
    trips = views.clean(spark, d).select(*keys)
    sinks.readable_export(trips, folder, full=False)
    sample = spark.read.schema(trips.schema).option("header", True).csv(f"{folder}/sample")
    strangers = sample.join(trips, keys, "left_anti")
    return sample.agg(F.count(F.lit(1)).alias("sampled")).select(
        "sampled", strangers.agg(F.count(F.lit(1))).scalar().alias("strangers")
    )


@query("k06_derived_tables", sql_from("legacy_cells", """
SELECT 'aggregated' AS table_name, count(*) AS row_count FROM legacy_cells
UNION ALL SELECT 'cell_statistics', count(DISTINCT cell_id) FROM legacy_cells
UNION ALL SELECT 'training', count(*) FROM legacy_cells
UNION ALL SELECT 'training_sample', least(10000, count(*)) FROM legacy_cells"""))
def k06(spark, d):
    folder = scratch_dir(spark, "derived")
    cells = features.legacy_features(views.legacy_cells(spark, d))
    sinks.write_derived_tables(
        cells, aggregates.cell_statistics, features.legacy_training_table, folder
    )
    tables = [
        (name, files.read_clean(spark, f"{folder}/{name}"))
        for name in ("aggregated", "cell_statistics", "training")
    ] + [("training_sample", files.read_csv_inferred(spark, f"{folder}/training_sample"))]
    return files.union_all([
        table.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, table in tables
    ])


@query("q06_csv_file_report", sql_from("raw", """
SELECT true AS every_file_named, true AS every_file_sized, count(*) AS records FROM raw"""))
def q06_csv(spark, d):
    """Totals over the report of a CSV folder; names and sizes are not known to SQL."""
    report = quality.file_report(files.read_raw_csv(spark, _csv_folder(spark, d)))
    return report.agg(
        F.bool_and(F.col("file_name").startswith("part-")).alias("every_file_named"),
        F.bool_and(F.col("size_bytes") > 0).alias("every_file_sized"),
        F.sum("records").alias("records"),
    )
