"""Aggregate, window, feature and analysis queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tripgrid import profiles
from tripgrid.functions.numeric import stable_avg
from tripgrid.operators import aggregates, analysis, features, joins, quality, quantiles, rollups
from tripgrid.operators.cleaning import prepare_trips
from tripgrid.operators.state import hotspots, overview_series
from tripgrid.plans import views
from tripgrid.plans.registry import query, rounded
from tripgrid.plans.views import (
    RUSH,
    sql_band,
    sql_from,
    sql_mean,
    sql_percent,
    sql_piecewise,
    sql_round,
    sql_speed_index,
)
from tripgrid.session import scratch_dir
from tripgrid.sources import fixtures
from tripgrid.sources.files import union_all


# Fixed-point means are equal on both sides to the last bit and stay unrounded. Deviations
# and variances are floating-point sums, so they are compared to 6 decimals.
_STD = ["speed_std"]
_ROUND_STD = "round(speed_std, 6) AS speed_std"

# ---- aggregates ---------------------------------------------------------------------------


@query("a01_cell_hour", sql_from("cells", f"""
SELECT * EXCLUDE (congestion_label, congestion_level) REPLACE ({_ROUND_STD}) FROM cells"""))
def a01(spark, d):
    return rounded(aggregates.cell_hour(views.clean(spark, d)), 6, _STD)


@query("a02_cell_hour_v1", sql_from("legacy_cells", f"""
SELECT * EXCLUDE (congestion_label, congestion_level, congestion_index)
  REPLACE ({_ROUND_STD}) FROM legacy_cells"""))
def a02(spark, d):
    return rounded(
        aggregates.cell_hour_legacy(views.clean(spark, d, profiles.LEGACY)), 6, _STD
    )


_MONTHLY_NAMES = ("avg_speed", "speed_std", "avg_distance", "weekend_ratio", "rush_hour_ratio")


@query("a03_cell_hour_of_day", sql_from("monthly", f"""
SELECT * REPLACE ({_ROUND_STD}) FROM monthly"""))
def a03(spark, d):
    return rounded(
        aggregates.cell_hour_of_day(views.clean(spark, d, profiles.COMPACT)), 6, _STD
    )


@query("a04_cell_hour_profile", sql_from("monthly", f"""
SELECT *,
  CASE WHEN avg_speed >= 20 THEN 0 WHEN avg_speed >= 10 THEN 1 ELSE 2 END::INT
    AS congestion_level,
  (cell_lat BETWEEN 13 AND 35 AND cell_lon BETWEEN 35 AND 50)::INT AS is_manhattan
FROM (SELECT cell_id, hour, {', '.join(f'{sql_mean(n, 6)} AS {n}' for n in _MONTHLY_NAMES)},
        sum(trip_count)::BIGINT AS trip_count, min(cell_lat) AS cell_lat, min(cell_lon) AS cell_lon
      FROM monthly GROUP BY ALL)"""))
def a04(spark, d):
    monthly = aggregates.cell_hour_of_day(views.clean(spark, d, profiles.COMPACT))
    return aggregates.cell_hour_profile(monthly)


@query("a05_cell_statistics", sql_from("legacy_cells", f"""
, counted AS (SELECT cell_id, congestion_label, count(*) AS n FROM legacy_cells GROUP BY ALL),
dominant AS (SELECT cell_id, congestion_label AS label FROM counted
  QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY n DESC, congestion_label) = 1),
means AS (SELECT cell_id, arg_min(cell_lat, hour_bucket) AS latitude,
    arg_min(cell_lon, hour_bucket) AS longitude, {sql_mean('avg_speed', 6)} AS typical_speed,
    avg(vehicle_count) AS typical_vehicle_count,
    {sql_mean('congestion_index', 6)} AS typical_congestion
  FROM legacy_cells GROUP BY ALL)
SELECT * EXCLUDE (label), label AS dominant_congestion_level,
  CASE label WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END AS dominant_congestion
FROM means JOIN dominant USING (cell_id)"""))
def a05(spark, d):
    return aggregates.cell_statistics(views.legacy_cells(spark, d))


@query("a06_trip_statistics", sql_from("clean", f"""
SELECT count(*) AS total_records, count(DISTINCT cell_id) AS unique_cells,
  min(speed_mph) AS min_speed, max(speed_mph) AS max_speed,
  {sql_mean('speed_mph', 2)} AS avg_speed FROM clean"""))
def a06(spark, d):
    return aggregates.trip_statistics(views.clean(spark, d))


@query("a06_rolled_up_days", sql_from("clean", f"""
SELECT date_trunc('day', pickup_datetime)::TIMESTAMP AS bucket, count(*) AS trip_count,
  {sql_mean('speed_mph', 2)} AS avg_speed, count(DISTINCT cell_id) AS cells FROM clean GROUP BY 1"""))
def a06_days(spark, d):
    """Days from stored hours; their cells come from merged sketches."""
    path = scratch_dir(spark, "hours")
    rollups.hourly(views.clean(spark, d)).write.parquet(path)
    return rollups.per_step(spark.read.parquet(path))


@query("d01_rolled_up_span", sql_from("clean", f"""
SELECT count(*) AS trip_count, {sql_mean('speed_mph', 2)} AS avg_speed, count(DISTINCT cell_id) AS cells
FROM clean WHERE pickup_datetime >= TIMESTAMP '2016-01-03 05:00:00' AND pickup_datetime < TIMESTAMP '2016-02-04 17:00:00'"""))
def d01_span(spark, d):
    path = scratch_dir(spark, "hours")
    rollups.hourly(views.clean(spark, d)).write.parquet(path)
    return rollups.span(spark.read.parquet(path), dt.datetime(2016, 1, 3, 5), dt.datetime(2016, 2, 4, 17))


@query("a07_trips_by_hour", sql_from("clean", """
SELECT hour, count(*) AS trip_count FROM clean GROUP BY hour"""))
def a07(spark, d):
    return aggregates.trips_by_hour(views.clean(spark, d))


@query("a08_date_range", sql_from("cells", """
SELECT min(hour_bucket) AS first_bucket, max(hour_bucket) AS last_bucket FROM cells"""))
def a08(spark, d):
    return aggregates.date_range(aggregates.cell_hour(views.clean(spark, d)))


@query("a09_class_distribution", sql_from("features", f"""
SELECT congestion_level, congestion_label, count(*) AS row_count,
  {sql_percent('count(*)', 'sum(count(*)) OVER ()')} AS percent
FROM features GROUP BY congestion_level, congestion_label"""))
def a09(spark, d):
    return aggregates.distribution(
        views.feature_rows(spark, d), "congestion_level", "congestion_label"
    )


@query("a09_split_distribution", sql_from("features", f"""
SELECT dataset_split, month, count(*) AS row_count,
  {sql_percent('count(*)', 'sum(count(*)) OVER ()')} AS percent
FROM features GROUP BY dataset_split, month"""))
def a09_split(spark, d):
    return aggregates.distribution(views.feature_rows(spark, d), "dataset_split", "month")


@query("a10_speed_by_hour", sql_from("clean", f"""
SELECT hour, avg_speed, {sql_band('avg_speed', profiles.HOUR_BANDS)} AS level
FROM (SELECT hour, {sql_round(sql_mean('speed_mph', 2), 2)} AS avg_speed FROM clean GROUP BY hour)"""))
def a10(spark, d):
    return analysis.speed_by_hour(views.clean(spark, d))


@query("a11_slow_hours", sql_from("clean", f"""
SELECT hour, avg_speed, {sql_band('avg_speed', profiles.HOUR_BANDS)} AS level
FROM (SELECT hour, {sql_round(sql_mean('speed_mph', 2), 2)} AS avg_speed FROM clean GROUP BY hour)
WHERE avg_speed < 15"""))
def a11(spark, d):
    return analysis.slow_hours(views.clean(spark, d))


@query("a12_busiest_cells", sql_from("clean", """
SELECT cell_id, trip_count, row_number() OVER (ORDER BY trip_count DESC, cell_id)::INT AS rank
FROM (SELECT cell_id, count(*) AS trip_count FROM clean GROUP BY cell_id)
ORDER BY rank LIMIT 20"""))
def a12(spark, d):
    return analysis.busiest_cells(views.clean(spark, d))


@query("a13_zone_comparison", sql_from("clean", f"""
SELECT CASE WHEN in_zone THEN 'Manhattan' ELSE 'Outer Boroughs' END AS zone,
  {sql_round(sql_mean('speed_mph', 2), 2)} AS avg_speed,
  {sql_round(sql_mean('trip_distance', 4), 2)} AS avg_distance, count(*) AS trip_count
FROM clean GROUP BY zone"""))
def a13(spark, d):
    return analysis.zone_comparison(views.clean(spark, d))


@query("a14_rush_hotspots", sql_from("clean", f"""
SELECT cell_id, avg_speed, trip_count,
  row_number() OVER (ORDER BY avg_speed, cell_id)::INT AS rank,
  {sql_band('avg_speed', profiles.SEVERITY_BANDS)} AS severity
FROM (SELECT cell_id, {sql_round(sql_mean('speed_mph', 2), 2)} AS avg_speed, count(*) AS trip_count
      FROM clean WHERE {RUSH} GROUP BY cell_id)
WHERE avg_speed < 20 AND trip_count >= 10"""))
def a14(spark, d):
    return analysis.rush_hotspots(views.clean(spark, d))


def _histogram_sql(view: str, value: str, bands, name: str = "bucket") -> str:
    return sql_from(view, f"""
SELECT {sql_band(value, bands)} AS {name}, count(*) AS row_count,
  {sql_percent('count(*)', 'sum(count(*)) OVER ()', 2)} AS percent FROM {view} GROUP BY {name}""")


@query("a15_speed_histogram", _histogram_sql("clean", "speed_mph", profiles.SPEED_BANDS))
def a15(spark, d):
    return analysis.speed_histogram(views.clean(spark, d))


@query("a15_speed_histogram_short",
       _histogram_sql("clean", "speed_mph", profiles.SPEED_BANDS_SHORT))
def a15_short(spark, d):
    return analysis.speed_histogram(views.clean(spark, d), profiles.SPEED_BANDS_SHORT)


@query("a16_weekday_profile", sql_from("clean", f"""
SELECT day_of_week, avg_speed, min_speed, max_speed, trip_count,
  ['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'][day_of_week]
    AS day_name,
  {sql_band('avg_speed', profiles.DAY_BANDS)} AS level
FROM (SELECT day_of_week, {sql_round(sql_mean('speed_mph', 2), 2)} AS avg_speed,
        min(speed_mph) AS min_speed, max(speed_mph) AS max_speed, count(*) AS trip_count
      FROM clean GROUP BY day_of_week)"""))
def a16(spark, d):
    return analysis.weekday_profile(views.clean(spark, d))


@query("a17_keyed_totals", """
SELECT l_orderkey % 100 AS key, sum(l_orderkey)::BIGINT AS total, count(*) AS n,
  avg(l_orderkey) AS mean FROM lineitem GROUP BY key""")
def a17(spark, d):
    lines = fixtures.table(spark, d, "lineitem")
    return analysis.keyed_totals(lines, F.col("l_orderkey") % 100, "l_orderkey")


@query("a18_count_by_column", sql_from("raw", """
SELECT passenger_count, count(*) AS row_count FROM raw GROUP BY passenger_count"""))
def a18(spark, d):
    return fixtures.typed_trips(spark, d).groupBy("passenger_count").agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query("a18_mean_of_column", f"""
SELECT {sql_mean('c_acctbal', 2)} AS avg_balance, count(*) AS row_count FROM customer""")
def a18_mean(spark, d):
    return fixtures.table(spark, d, "customer").agg(
        stable_avg("c_acctbal").alias("avg_balance"), F.count(F.lit(1)).alias("row_count")
    )


_DESCRIBED = ("trip_distance", "speed_mph", "duration_hours", "fare_amount", "passenger_count")


def _describe_sql(view: str, names) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS column_name, count({n}) AS count, round(avg({n}::DOUBLE), 6) AS mean, "
        f"round(stddev_samp({n}::DOUBLE), 6) AS std, min({n})::DOUBLE AS min, "
        f"max({n})::DOUBLE AS max FROM {view}"
        for n in names
    )


@query("a19_describe", sql_from("clean", _describe_sql("clean", _DESCRIBED)))
def a19(spark, d):
    return rounded(
        quality.describe_numeric(views.clean(spark, d), list(_DESCRIBED)), 6, ["mean", "std"]
    )


@query("a25_peak_times", sql_from("clean", """
SELECT 'hour' AS kind, first(hour ORDER BY n DESC, hour) AS peak, max(n) AS trip_count
FROM (SELECT hour, count(*) AS n FROM clean GROUP BY hour)
UNION ALL SELECT 'weekday', first(day_of_week ORDER BY n DESC, day_of_week), max(n)
FROM (SELECT day_of_week, count(*) AS n FROM clean GROUP BY day_of_week)"""))
def a25(spark, d):
    return analysis.peak_times(views.clean(spark, d))


def _robust_sql(value: str, where: str) -> str:
    return sql_from("prepared", f"""
SELECT count({value}) AS value_count, {sql_mean(value, 6)} AS mean,
  round(quantile_cont({value}, 0.5), 6) AS median, round(stddev_samp({value}), 6) AS std,
  min({value}) AS min, max({value}) AS max
FROM prepared WHERE {where}""")


_ROBUST = ["median", "std"]


def _unrounded(spark, d):
    return prepare_trips(fixtures.typed_trips(spark, d), profiles.COMPACT)


@query("a26_robust_distance", _robust_sql(
    "trip_distance", "trip_distance > 0 AND trip_distance < 50"))
def a26_distance(spark, d):
    valid = (F.col("trip_distance") > 0) & (F.col("trip_distance") < 50)
    return rounded(
        analysis.robust_statistics(_unrounded(spark, d), "trip_distance", valid), 6, _ROBUST
    )


@query("a26_robust_speed", _robust_sql("raw_speed", "raw_speed > 0 AND raw_speed < 60"))
def a26_speed(spark, d):
    valid = (F.col("speed_mph") > 0) & (F.col("speed_mph") < 60)
    return rounded(
        analysis.robust_statistics(_unrounded(spark, d), "speed_mph", valid), 6, _ROBUST
    )


_EXTREMES = """CASE l_partkey % 4 WHEN 0 THEN (l_suppkey % 11 - 5) * 3.4e307::DOUBLE
  WHEN 1 THEN (l_suppkey % 11 - 5) * 1e-322::DOUBLE WHEN 2 THEN (l_suppkey % 11 - 5)::DOUBLE
  ELSE (l_suppkey % 11 - 5) * 1e-300::DOUBLE END"""


@query("a26_extreme_quantiles", f"""
SELECT l_linenumber, count(*) AS value_count, min(v) AS low, quantile_cont(v, 0.5) AS median, max(v) AS high
FROM (SELECT l_linenumber, {_EXTREMES} AS v FROM lineitem WHERE l_linenumber < 4) GROUP BY l_linenumber""")
def a26_extreme(spark, d):
    """From the largest doubles to subnormals, in intervals cut down to two values."""
    line = fixtures.table(spark, d, "lineitem").filter("l_linenumber < 4")
    k = (F.col("l_suppkey") % 11 - 5).cast("double")
    part = F.col("l_partkey") % 4
    v = F.when(part == 0, k * 3.4e307).when(part == 1, k * 1e-322).when(part == 2, k).otherwise(k * 1e-300)
    found = quantiles.exact_quantiles(
        line.withColumn("v", v), "v", {"low": 0.0, "median": 0.5, "high": 1.0}, ("l_linenumber",), largest=2
    )
    return found


@query("a27_speed_classes", sql_from("clean", f"""
SELECT high, medium, low, total, {sql_percent('high', 'total')} AS high_percent,
  {sql_percent('medium', 'total')} AS medium_percent, {sql_percent('low', 'total')} AS low_percent
FROM (SELECT count(*) FILTER (speed_mph < 10) AS high,
        count(*) FILTER (speed_mph >= 10 AND speed_mph < 20) AS medium,
        count(*) FILTER (speed_mph >= 20) AS low, count(speed_mph) AS total FROM clean)"""))
def a27(spark, d):
    return analysis.speed_classes(views.clean(spark, d))


def _width_sql(value: str) -> str:
    return sql_from("clean", f"""
SELECT least(coalesce(floor(({value} - low) * 50.0::DOUBLE / nullif(high - low, 0))::BIGINT, 0),
             49)::INT AS bin, count(*) AS row_count
FROM clean, (SELECT min({value}) AS low, max({value}) AS high FROM clean) GROUP BY bin""")


@query("a28_speed_bins", _width_sql("speed_mph"))
def a28_speed(spark, d):
    return analysis.width_histogram(views.clean(spark, d), "speed_mph")


@query("a28_distance_bins", _width_sql("trip_distance"))
def a28_distance(spark, d):
    return analysis.width_histogram(views.clean(spark, d), "trip_distance")


# ---- windows and features -----------------------------------------------------------------

_LAG_NAMES = (
    "prev_trip_count", "prev_avg_speed", "prev_congestion_label", "prev_2h_trip_count",
    "prev_2h_avg_speed",
)


@query("w01_lags", sql_from("lagged", f"""
SELECT cell_id, hour_bucket, {', '.join(_LAG_NAMES)} FROM lagged"""))
def w01(spark, d):
    return features.with_lags(views.labelled(spark, d)).select(
        "cell_id", "hour_bucket", *_LAG_NAMES
    )


@query("w01_lags_strict_hour", sql_from("cells", """
SELECT c.cell_id, c.hour_bucket, p.trip_count AS prev_trip_count, p.avg_speed AS prev_avg_speed,
  p.congestion_label AS prev_congestion_label, q.trip_count AS prev_2h_trip_count,
  q.avg_speed AS prev_2h_avg_speed
FROM cells c
LEFT JOIN cells p ON p.cell_id = c.cell_id AND p.hour_bucket = c.hour_bucket - INTERVAL 1 HOUR
LEFT JOIN cells q ON q.cell_id = c.cell_id AND q.hour_bucket = c.hour_bucket - INTERVAL 2 HOUR"""))
def w01_strict(spark, d):
    return features.with_lags(views.labelled(spark, d), strict_hour=True).select(
        "cell_id", "hour_bucket", *_LAG_NAMES
    )


@query("w02_history", sql_from("lagged", """
SELECT cell_id, hour_bucket, historical_avg_trips, historical_avg_speed FROM lagged"""))
def w02(spark, d):
    return features.with_history(views.labelled(spark, d)).select(
        "cell_id", "hour_bucket", "historical_avg_trips", "historical_avg_speed"
    )


@query("w03_top_rank", sql_from("cells", """
SELECT cell_id, hour_bucket, trip_count,
  row_number() OVER (ORDER BY trip_count DESC, cell_id, hour_bucket)::INT AS rank
FROM cells ORDER BY rank LIMIT 25"""))
def w03(spark, d):
    cells = aggregates.cell_hour(views.clean(spark, d)).select("cell_id", "hour_bucket", "trip_count")
    return analysis.top_k(
        cells, 25, F.desc("trip_count"), F.col("cell_id"), F.col("hour_bucket")
    )


@query("w04_density", sql_from("cells", f"""
SELECT cell_id, hour_bucket, density AS density_score,
  CASE WHEN {RUSH} THEN density ELSE 0 END AS rush_hour_density
FROM (SELECT *, trip_count::DOUBLE / (SELECT max(trip_count) FROM cells) AS density FROM cells)"""))
def w04(spark, d):
    cells = analysis.with_density(features.with_time_flags(views.labelled(spark, d)))
    return cells.select(
        "cell_id", "hour_bucket", "density_score",
        (F.col("is_rush_hour") * F.col("density_score")).alias("rush_hour_density"),
    )


@query("w05_spread", sql_from("cells", """
SELECT cell_id, hour_bucket, round(coalesce(speed_std / nullif(avg_speed, 0), 0), 6)
    AS speed_coefficient_var, max_speed - min_speed AS speed_range FROM cells"""))
def w05(spark, d):
    return rounded(views.labelled(spark, d).select(
        "cell_id", "hour_bucket",
        features.variation("speed_std", "avg_speed").alias("speed_coefficient_var"),
        (F.col("max_speed") - F.col("min_speed")).alias("speed_range"),
    ), 6, ["speed_coefficient_var"])


def _overview_series_sql(tail: str = "") -> str:
    return sql_from("cells", f"""
SELECT hour_bucket AS bucket, count(*) AS total_cells, sum(trip_count)::BIGINT AS total_vehicles,
  {sql_mean('idx', 6)} AS avg_congestion, {sql_mean('avg_speed', 6)} AS avg_speed
FROM (SELECT *, {sql_piecewise('avg_speed', 0.10, 0.95)} AS idx FROM cells)
GROUP BY bucket {tail}""")


@query("w06_recent_points", _overview_series_sql("ORDER BY bucket DESC LIMIT 12"))
def w06(spark, d):
    return analysis.recent_points(overview_series(views.labelled(spark, d)), 12)


@query("w07_percent_of_total", sql_from("clean", f"""
SELECT hour, count(*) AS row_count, {sql_percent('count(*)', 'sum(count(*)) OVER ()', 2)} AS percent
FROM clean GROUP BY hour"""))
def w07(spark, d):
    return aggregates.distribution(views.clean(spark, d), "hour", digits=2)


@query("m01_feature_table", sql_from("features", "SELECT * FROM features"))
def m01(spark, d):
    return views.feature_rows(spark, d)


@query("m02_training_table_v1", sql_from("legacy_cells", f"""
SELECT hour, day_of_week, CASE WHEN {RUSH} THEN 1 ELSE 0 END::INT AS is_rush_hour,
  (hour >= 22 OR hour <= 5)::INT AS is_night, (day_of_week >= 5)::INT AS is_weekend,
  avg_speed, {_ROUND_STD}, max_speed - min_speed AS speed_range, vehicle_count,
  vehicle_count::DOUBLE / (SELECT max(vehicle_count) FROM legacy_cells) AS density_score,
  avg_distance, avg_duration, congestion_label, cell_id, hour_bucket FROM legacy_cells"""))
def m02(spark, d):
    cells = features.legacy_features(views.legacy_cells(spark, d))
    return rounded(features.legacy_training_table(cells), 6, _STD)


@query("m03_temporal_split", sql_from("features", """
SELECT dataset_split AS side, count(*) AS row_count, min(hour_bucket) AS first_bucket,
  max(hour_bucket) AS last_bucket FROM features WHERE dataset_split <> 'other'
GROUP BY dataset_split"""))
def m03(spark, d):
    train, test = features.temporal_split(views.feature_rows(spark, d))
    sides = train.unionByName(test).groupBy(F.col("dataset_split").alias("side"))
    return sides.agg(
        F.count(F.lit(1)).alias("row_count"), F.min("hour_bucket").alias("first_bucket"),
        F.max("hour_bucket").alias("last_bucket"),
    )


# ---- sort, top-k, sampling, sets ------------------------------------------------------------


@query("o01_global_sort", "SELECT c_custkey, c_acctbal FROM customer")
def o01(spark, d):
    """All rows in order: a range-partitioned sort, whose order the tests check."""
    customers = fixtures.table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return customers.orderBy(F.desc("c_acctbal"), "c_custkey")


@query("o05_hash_sample", """
SELECT event_id, user_id, event_type FROM events
ORDER BY ('0x' || substr(md5(event_id::VARCHAR), 1, 8))::BIGINT % 65536, md5(event_id::VARCHAR)
LIMIT 1000""")
def o05_hash(spark, d):
    rows = fixtures.table(spark, d, "events").select("event_id", "user_id", "event_type")
    return analysis.hash_sample(rows, 1000, ["event_id"])


@query("o05_bernoulli_sample")
def o05(spark, d):
    return analysis.bernoulli_sample(fixtures.table(spark, d, "lineitem"), 0.05, seed=42)


@query("o05_replacement_sample")
def o05_replacement(spark, d):
    return analysis.bernoulli_sample(
        fixtures.table(spark, d, "lineitem"), 0.05, seed=42, replace=True
    )


@query("o06_random_split")
def o06(spark, d):
    train, test = views.feature_rows(spark, d).randomSplit([0.8, 0.2], seed=42)
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    ).groupBy("side").agg(F.count(F.lit(1)).alias("row_count"))


@query("o07_head", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey, o_totalprice LIMIT 5""")
def o07(spark, d):
    orders = fixtures.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy("o_orderkey", "o_totalprice").limit(5)


@query("u01_union_all", sql_from("clean", """
SELECT month, count(*) AS row_count, count(DISTINCT cell_id) AS cells FROM clean GROUP BY month"""))
def u01(spark, d):
    """The monthly tables put back together, as many as there are."""
    trips = views.clean(spark, d)
    found = trips.select("year", "month").distinct().orderBy("year", "month").collect()
    months = [trips.filter((F.col("year") == r[0]) & (F.col("month") == r[1])) for r in found]
    return union_all(months).groupBy("month").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("cell_id").alias("cells")
    )


@query("u02_distinct_cells", sql_from("clean", """
SELECT DISTINCT cell_id, cell_lat, cell_lon FROM clean"""))
def u02(spark, d):
    return views.clean(spark, d).select("cell_id", "cell_lat", "cell_lon").distinct()


# ---- zones ----------------------------------------------------------------------------------

_ZONES_SQL = ", ".join(
    f"({i}, '{n}', {a}::DOUBLE, {o}::DOUBLE, {r}::DOUBLE)"
    for i, (n, a, o, r) in enumerate(profiles.LANDMARKS, 1)
)
_MATCH_SQL = f"""
, zones AS (SELECT * FROM (VALUES {_ZONES_SQL}) t(zone_order, name, lat, lon, radius)),
ranked AS (SELECT *, row_number() OVER (ORDER BY congestion_index DESC, cell_id) AS rank FROM state),
hits AS (SELECT cell_id, first(name ORDER BY zone_order) AS zone_name FROM state s JOIN zones z
  ON sqrt((s.latitude - z.lat) * (s.latitude - z.lat)
          + (s.longitude - z.lon) * (s.longitude - z.lon)) < z.radius GROUP BY cell_id)"""


@query("j02_landmark_names", sql_from("state", _MATCH_SQL + """
SELECT rank::INT AS rank, cell_id, coalesce(zone_name, 'Zone ' || rank) AS zone_name
FROM ranked LEFT JOIN hits USING (cell_id) WHERE rank <= 50"""))
def j02(spark, d):
    top = hotspots(views.traffic_state(spark, d), 50)
    return top.select(
        "rank", "cell_id",
        joins.zone_display_name("latitude", "longitude", "rank").alias("zone_name"),
    )


@query("j02_zone_table_match", sql_from("state", _MATCH_SQL + """
SELECT cell_id, zone_name FROM state LEFT JOIN hits USING (cell_id)"""))
def j02_table(spark, d):
    state = views.traffic_state(spark, d).select("cell_id", "latitude", "longitude")
    return joins.match_zones(state, joins.landmark_table(spark)).select("cell_id", "zone_name")


@query("j02_repeated_points", sql_from("state", _MATCH_SQL + """
SELECT cell_id, zone_name FROM state LEFT JOIN hits USING (cell_id)
UNION ALL SELECT cell_id, zone_name FROM state LEFT JOIN hits USING (cell_id)"""))
def j02_repeated(spark, d):
    """Points that occur twice stay two; the salted way, for zone tables of any size."""
    state = views.traffic_state(spark, d).select("cell_id", "latitude", "longitude")
    twice = state.unionByName(state)
    matched = joins.match_zones(twice, joins.landmark_table(spark), broadcast_zones=0)
    return matched.select("cell_id", "zone_name")


@query("j02_crowded_tiles", """
WITH zones AS (SELECT p_partkey AS zone_order, 'zone_' || p_partkey AS name,
    40.7::DOUBLE + (p_partkey * 37 % 1000) * 1e-5::DOUBLE AS lat,
    -74.0::DOUBLE + (p_partkey * 91 % 1000) * 1e-5::DOUBLE AS lon,
    0.0004::DOUBLE + (p_partkey % 7) * 1e-4::DOUBLE AS radius FROM part),
points AS (SELECT c_custkey AS id, 40.7::DOUBLE + (c_custkey * 13 % 1000) * 1e-5::DOUBLE AS lat,
    -74.0::DOUBLE + (c_custkey * 57 % 1003) * 1e-5::DOUBLE AS lon FROM customer),
hits AS (SELECT p.id, first(name ORDER BY zone_order) AS zone_name FROM points p JOIN zones z
  ON sqrt((p.lat - z.lat) * (p.lat - z.lat) + (p.lon - z.lon) * (p.lon - z.lon)) < z.radius GROUP BY p.id)
SELECT id, zone_name FROM points LEFT JOIN hits USING (id)""")
def j02_crowded(spark, d):
    """As many zones as parts within one tile; lists of at most 20 zones."""
    k = F.col("p_partkey")
    zones = fixtures.table(spark, d, "part").select(
        k.alias("zone_order"), F.concat(F.lit("zone_"), k.cast("string")).alias("name"),
        (F.lit(40.7) + (k * 37 % 1000) * 1e-5).alias("lat"), (F.lit(-74.0) + (k * 91 % 1000) * 1e-5).alias("lon"),
        (F.lit(0.0004) + (k % 7) * 1e-4).alias("radius"),
    )
    c = F.col("c_custkey")
    points = fixtures.table(spark, d, "customer").select(
        c.alias("id"), (F.lit(40.7) + (c * 13 % 1000) * 1e-5).alias("latitude"),
        (F.lit(-74.0) + (c * 57 % 1003) * 1e-5).alias("longitude"),
    )
    return joins.match_zones(points, zones, crowd=20).select("id", "zone_name")


@query("j02_trips_per_landmark", sql_from("clean", f"""
, zones AS (SELECT * FROM (VALUES {_ZONES_SQL}) t(zone_order, name, lat, lon, radius)),
points AS (SELECT pickup_lat AS lat, pickup_lon AS lon, count(*) AS n FROM clean GROUP BY ALL),
hits AS (SELECT p.lat, p.lon, any_value(p.n) AS n, first(name ORDER BY zone_order) AS zone_name
  FROM points p JOIN zones z ON sqrt((p.lat - z.lat) * (p.lat - z.lat)
    + (p.lon - z.lon) * (p.lon - z.lon)) < z.radius GROUP BY p.lat, p.lon)
SELECT coalesce(h.zone_name, 'none') AS zone_name, sum(p.n)::BIGINT AS trip_count
FROM points p LEFT JOIN hits h ON h.lat = p.lat AND h.lon = p.lon GROUP BY 1"""))
def j02_trips(spark, d):
    """Trips per landmark; those in no landmark under a name of their own."""
    zone = F.coalesce(joins.landmark_name("pickup_lat", "pickup_lon"), F.lit("none"))
    return views.clean(spark, d).groupBy(zone.alias("zone_name")).agg(
        F.count(F.lit(1)).alias("trip_count")
    )


@query("j03_box_zone", sql_from("clean", """
SELECT pickup_datetime, cell_id,
  CASE WHEN in_zone THEN 'Manhattan' ELSE 'Outer Boroughs' END AS zone FROM clean"""))
def j03(spark, d):
    zone = joins.box_zone(
        "pickup_lat", "pickup_lon", {"Manhattan": profiles.ZONE_BOX}, "Outer Boroughs"
    )
    return views.clean(spark, d).select("pickup_datetime", "cell_id", zone.alias("zone"))


# ---- described in the documentation only ------------------------------------------------------


def _history_sql(trunc: str) -> str:
    return sql_from("clean", f"""
SELECT {trunc} AS bucket, {sql_mean(sql_speed_index('speed_mph'), 6)} AS avg_congestion,
  count(*) AS total_vehicles, {sql_mean('speed_mph', 2)} AS avg_speed
FROM clean GROUP BY bucket""")


@query("d01_history_hourly_doc", _history_sql("date_trunc('hour', pickup_datetime)"))
def d01(spark, d):
    return analysis.history_series(views.clean(spark, d))


@query("d01_history_15min_doc", _history_sql("time_bucket(INTERVAL 15 MINUTE, pickup_datetime)"))
def d01_15(spark, d):
    return analysis.history_series(views.clean(spark, d), "15 minutes")


@query("d01_history_last_day_doc", sql_from("clean", f"""
SELECT date_trunc('hour', pickup_datetime) AS bucket,
  {sql_mean(sql_speed_index('speed_mph'), 6)} AS avg_congestion,
  count(*) AS total_vehicles, {sql_mean('speed_mph', 2)} AS avg_speed
FROM clean
WHERE pickup_datetime > (SELECT max(pickup_datetime) FROM clean) - INTERVAL 24 HOUR
GROUP BY bucket"""))
def d01_last(spark, d):
    return analysis.history_series(views.clean(spark, d), hours=24)


@query("d02_cell_history_doc", sql_from("cells", f"""
SELECT cell_id, day, {sql_mean('idx', 6)} AS avg_congestion, max(idx) AS peak_congestion, first(hour ORDER BY idx DESC, hour) AS peak_hour,
  min(idx) AS low_congestion, first(hour ORDER BY idx, hour) AS low_hour
FROM (SELECT cell_id, hour, hour_bucket::DATE::TIMESTAMP AS day,
        {sql_speed_index('avg_speed')} AS idx FROM cells)
GROUP BY cell_id, day"""))
def d02(spark, d):
    return analysis.cell_history(views.labelled(spark, d))


@query("d03_zone_percentiles_doc", sql_from("clean", """
SELECT CASE WHEN is_manhattan THEN 'Manhattan' ELSE 'Outer Boroughs' END AS zone,
  count(*) AS value_count, round(quantile_cont(speed_mph, 0.25), 6) AS p25,
  round(quantile_cont(speed_mph, 0.5), 6) AS p50, round(quantile_cont(speed_mph, 0.75), 6) AS p75,
  round(quantile_cont(speed_mph, 0.9), 6) AS p90 FROM clean GROUP BY zone"""))
def d03(spark, d):
    return rounded(analysis.zone_speed_percentiles(views.clean(spark, d)), 6)


@query("d04_hourly_trend_doc", sql_from("cells", f"""
, series AS (SELECT cell_id, hour_bucket, {sql_speed_index('avg_speed')} AS idx FROM cells),
changed AS (SELECT *, CASE WHEN hour_bucket - lag(hour_bucket) OVER w = INTERVAL 1 HOUR
    THEN (idx - lag(idx) OVER w) * 100.0::DOUBLE END AS change_1h FROM series
  WINDOW w AS (PARTITION BY cell_id ORDER BY hour_bucket))
SELECT cell_id, hour_bucket, idx AS congestion_index, change_1h,
  CASE WHEN change_1h > 1 THEN 'increasing' WHEN change_1h < -1 THEN 'decreasing' ELSE 'stable' END
    AS trend FROM changed"""))
def d04(spark, d):
    return analysis.hourly_trend(views.labelled(spark, d)).select(
        "cell_id", "hour_bucket", "congestion_index", "change_1h", "trend"
    )


@query("d05_distance_segments_doc", _histogram_sql(
    "clean", "trip_distance", profiles.DISTANCE_SEGMENTS, "segment"))
def d05(spark, d):
    return analysis.distance_segments(views.clean(spark, d))


def _rolling_sql(hours: int) -> str:
    frame = f"RANGE BETWEEN INTERVAL {hours - 1} HOUR PRECEDING AND CURRENT ROW"
    over = f"OVER (PARTITION BY cell_id ORDER BY hour_bucket {frame})"
    fixed = "floor(avg_speed * 1e6::DOUBLE + 0.5::DOUBLE)::BIGINT"
    return (
        f"(sum({fixed}) {over})::DOUBLE / ((count(*) {over})::DOUBLE * 1e6::DOUBLE)"
        f" AS avg_speed_{hours}h"
    )


@query("d07_rolling_means_doc", sql_from("cells", f"""
SELECT cell_id, hour_bucket, {', '.join(_rolling_sql(n) for n in (3, 6, 24))} FROM cells"""))
def d07(spark, d):
    return features.rolling_means(views.labelled(spark, d)).select(
        "cell_id", "hour_bucket", "avg_speed_3h", "avg_speed_6h", "avg_speed_24h"
    )


@query("d09_speed_variance_doc", sql_from("clean", """
SELECT cell_id, count(*) AS trip_count, round(coalesce(var_samp(speed_mph), 0), 6) AS speed_variance
FROM clean GROUP BY cell_id"""))
def d09(spark, d):
    return rounded(analysis.speed_variance(views.clean(spark, d)), 6)
