"""Projection, predicate, cleaning, temporal and label queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripgrid import profiles
from tripgrid.functions import grid, labels, temporal
from tripgrid.functions.numeric import band, clamp
from tripgrid.operators import cleaning
from tripgrid.operators.features import with_time_flags
from tripgrid.plans import views
from tripgrid.plans.registry import query
from tripgrid.plans.views import (
    RUSH,
    sql_band,
    sql_from,
    sql_level,
    sql_piecewise,
    sql_round,
    sql_speed_index,
)
from tripgrid.sources import fixtures
from tripgrid.streaming import events

_RAW_SQL_COLUMNS = """pickup_datetime, dropoff_datetime, pickup_lat, pickup_lon, dropoff_lat,
  dropoff_lon, trip_distance, passenger_count"""
_RAW_COLUMNS = (
    "pickup_datetime", "dropoff_datetime", "pickup_lat", "pickup_lon", "dropoff_lat",
    "dropoff_lon", "trip_distance", "passenger_count",
)
_FAULTY = """faulty AS (
  SELECT CASE WHEN l_orderkey % 211 = 0 THEN NULL ELSE pickup_datetime END AS pickup_datetime,
    CASE WHEN l_orderkey % 307 = 0 THEN pickup_datetime ELSE dropoff_datetime END
      AS dropoff_datetime,
    pickup_lat, pickup_lon, dropoff_lat, dropoff_lon, trip_distance,
    CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE passenger_count END AS passenger_count,
    fare_amount, total_amount
  FROM raw)"""


def sql_faulty(body: str) -> str:
    return sql_from("raw", "").rstrip() + ",\n" + _FAULTY + "\n" + body.strip()


@query("p01_rename", sql_from("raw", f"""
SELECT strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_datetime,
  strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS dropoff_datetime,
  pickup_lat, pickup_lon, dropoff_lat, dropoff_lon, trip_distance, passenger_count FROM raw"""))
def p01(spark, d):
    trips = fixtures.raw_trips(spark, d)
    upper = trips.toDF(*[c.upper() for c in trips.columns])
    return cleaning.standardize_columns(upper).select(*_RAW_COLUMNS)


@query("p02_parse_datetimes", sql_faulty("""
SELECT pickup_datetime, dropoff_datetime, trip_distance FROM faulty"""))
def p02(spark, d):
    trips = cleaning.standardize_columns(fixtures.faulty_trips(spark, d))
    return cleaning.parse_datetimes(trips).select(
        "pickup_datetime", "dropoff_datetime", "trip_distance"
    )


def _prepared(spark, d, profile=profiles.STANDARD):
    return cleaning.prepare_trips(fixtures.typed_trips(spark, d), profile)


@query("p03_city_box", sql_from("prepared", f"""
SELECT {_RAW_SQL_COLUMNS} FROM prepared WHERE in_city"""))
def p03(spark, d):
    trips = cleaning.standardize_columns(fixtures.typed_trips(spark, d))
    return trips.filter(cleaning.cleaning_rules(trips, profiles.STANDARD)["coordinates"]).select(
        *_RAW_COLUMNS
    )


@query("p04_duration", sql_from("prepared", """
SELECT pickup_datetime, dur_s AS duration_seconds, duration_hours,
  dur_s / 60.0::DOUBLE AS duration_minutes FROM prepared"""))
def p04(spark, d):
    return _prepared(spark, d).select(
        "pickup_datetime", "duration_seconds", "duration_hours", "duration_minutes"
    )


@query("p05_duration_filter", sql_from("prepared", """
SELECT pickup_datetime, dur_s AS duration_seconds FROM prepared WHERE dur_s BETWEEN 60 AND 10800"""))
def p05(spark, d):
    return _prepared(spark, d).filter(profiles.STANDARD.duration_s.holds("duration_seconds")).select(
        "pickup_datetime", "duration_seconds"
    )


@query("p06_distance_filter", sql_from("prepared", """
SELECT 'standard' AS profile, pickup_datetime, trip_distance FROM prepared
WHERE trip_distance BETWEEN 0.1::DOUBLE AND 100
UNION ALL SELECT 'v1', pickup_datetime, trip_distance FROM prepared
WHERE trip_distance > 0.1::DOUBLE AND trip_distance < 100
UNION ALL SELECT 'v2', pickup_datetime, trip_distance FROM prepared
WHERE trip_distance > 0 AND trip_distance < 100
UNION ALL SELECT 'doc', pickup_datetime, trip_distance FROM prepared WHERE trip_distance > 0"""))
def p06(spark, d):
    trips = _prepared(spark, d)
    kept = [
        F.when(p.distance.holds("trip_distance"), F.lit(name))
        for name, p in profiles.CLEAN_PROFILES.items()
    ]
    return trips.select(
        F.explode(F.array_compact(F.array(*kept))).alias("profile"),
        "pickup_datetime", "trip_distance",
    )


@query("p07_speed", sql_from("prepared", """
SELECT pickup_datetime, trip_distance, speed_mph, raw_speed AS raw_speed FROM prepared"""))
def p07(spark, d):
    return _prepared(spark, d).select(
        "pickup_datetime", "trip_distance", "speed_mph",
        F.try_divide("trip_distance", "duration_hours").alias("raw_speed"),
    )


@query("p08_speed_filter", sql_from("prepared", """
SELECT 'standard' AS profile, pickup_datetime, speed_mph AS speed FROM prepared
WHERE speed_mph BETWEEN 1 AND 60
UNION ALL SELECT 'v1', pickup_datetime, raw_speed FROM prepared
WHERE raw_speed > 0 AND raw_speed < 80
UNION ALL SELECT 'v2', pickup_datetime, raw_speed FROM prepared
WHERE raw_speed > 0 AND raw_speed < 60
UNION ALL SELECT 'doc', pickup_datetime, raw_speed FROM prepared"""))
def p08(spark, d):
    """The documented profile has no speed rule and keeps every row."""
    raw = F.try_divide("trip_distance", "duration_hours")
    trips = _prepared(spark, d).withColumn("raw_speed", raw)
    kept = []
    for name, profile in profiles.CLEAN_PROFILES.items():
        speed = F.col("speed_mph" if profile.speed_decimals is not None else "raw_speed")
        held = profile.speed.holds(speed) if profile.speed else F.lit(True)
        kept.append(F.when(held, F.struct(F.lit(name).alias("profile"), speed.alias("speed"))))
    return trips.select(
        "pickup_datetime", F.explode(F.array_compact(F.array(*kept))).alias("k")
    ).select("k.profile", "pickup_datetime", "k.speed")


@query("p09_grid_cell", sql_from("prepared", """
SELECT pickup_lat, pickup_lon, cell_lat, cell_lon,
  'cell_' || cell_lat || '_' || cell_lon AS cell_id FROM prepared WHERE in_city"""))
def p09(spark, d):
    trips = _prepared(spark, d)
    inside = trips.filter(cleaning.cleaning_rules(trips, profiles.STANDARD)["coordinates"])
    return grid.with_cell(inside, profiles.STANDARD.grid).select(
        "pickup_lat", "pickup_lon", "cell_lat", "cell_lon", "cell_id"
    )


@query("p10_grid_cell_absolute", sql_from("legacy", """
SELECT pickup_lat, pickup_lon, cell_lat_idx, cell_lon_idx, cell_id,
  cell_center_lat, cell_center_lon
FROM legacy"""))
def p10(spark, d):
    return views.clean(spark, d, profiles.LEGACY).select(
        "pickup_lat", "pickup_lon", "cell_lat_idx", "cell_lon_idx", "cell_id",
        "cell_center_lat", "cell_center_lon",
    )


@query("p11_cell_centres", sql_from("clean", """
SELECT cell_id, 40.4855::DOUBLE + (cell_lat + 0.5::DOUBLE) * 0.0096::DOUBLE AS latitude,
  -74.2567::DOUBLE + (cell_lon + 0.5::DOUBLE) * 0.009928::DOUBLE AS longitude,
  40.4855::DOUBLE + cell_lat * 0.01::DOUBLE AS bridge_latitude,
  -74.2567::DOUBLE + cell_lon * 0.01::DOUBLE AS bridge_longitude
FROM (SELECT DISTINCT cell_id, cell_lat, cell_lon FROM clean)"""))
def p11(spark, d):
    cells = views.clean(spark, d).select("cell_id", "cell_lat", "cell_lon").distinct()
    lat, lon = grid.centre_coordinates("cell_lat", "cell_lon", profiles.STATE_CENTRES)
    blat, blon = grid.centre_coordinates("cell_lat", "cell_lon", profiles.BRIDGE_CENTRES)
    return cells.select(
        "cell_id", lat.alias("latitude"), lon.alias("longitude"),
        blat.alias("bridge_latitude"), blon.alias("bridge_longitude"),
    )


@query("p12_calendar", sql_from("prepared", """
SELECT pickup_datetime, hour, day_of_week, month, year, weekday0 AS weekday_monday0,
  weekday0 + 1 AS weekday_monday1, day(pickup_datetime)::INT AS day,
  dayname(pickup_datetime) AS day_name FROM prepared"""))
def p12(spark, d):
    ts = F.col("pickup_datetime")
    return cleaning.with_calendar(_prepared(spark, d)).select(
        "pickup_datetime", "hour", "day_of_week", "month", "year",
        temporal.day_number(ts, "monday0").alias("weekday_monday0"),
        temporal.day_number(ts, "monday1").alias("weekday_monday1"),
        F.dayofmonth(ts).alias("day"),
        F.date_format(ts, "EEEE").alias("day_name"),
    )


@query("p13_zone_flag", sql_from("prepared", """
SELECT pickup_lat, pickup_lon, in_zone AS is_manhattan,
  (pickup_lat BETWEEN 40.70::DOUBLE AND 40.82::DOUBLE
   AND pickup_lon BETWEEN -74.02::DOUBLE AND -73.93::DOUBLE)::INT AS is_manhattan_stream,
  (cell_lat BETWEEN 13 AND 35 AND cell_lon BETWEEN 35 AND 50)::INT AS is_manhattan_cells
FROM prepared"""))
def p13(spark, d):
    trips = grid.with_cell(
        cleaning.with_zone_flag(_prepared(spark, d)), profiles.STANDARD.grid
    )
    narrow = profiles.STREAM_ZONE_BOX.contains("pickup_lat", "pickup_lon")
    cells = profiles.ZONE_CELL_BOX.contains("cell_lat", "cell_lon")
    return trips.select(
        "pickup_lat", "pickup_lon", "is_manhattan",
        narrow.cast("int").alias("is_manhattan_stream"),
        cells.cast("int").alias("is_manhattan_cells"),
    )


_CLEAN_SQL = """SELECT pickup_datetime, dropoff_datetime, pickup_lat, pickup_lon, dropoff_lat,
  dropoff_lon, trip_distance, duration_hours, speed_mph,
  passenger_count, fare_amount, total_amount,
  cell_id, cell_lat, cell_lon, hour, day_of_week, month, year, is_manhattan FROM clean"""


@query("p14_clean_columns", sql_from("clean", _CLEAN_SQL))
def p14(spark, d):
    return views.clean(spark, d)


@query("p15_drop_nulls", sql_faulty(f"""
SELECT {_RAW_SQL_COLUMNS} FROM faulty
WHERE pickup_datetime IS NOT NULL AND passenger_count IS NOT NULL"""))
def p15(spark, d):
    trips = cleaning.standardize_columns(fixtures.faulty_trips(spark, d))
    parsed = cleaning.parse_datetimes(trips).select(*_RAW_COLUMNS)
    return parsed.na.drop(subset=["pickup_datetime", "passenger_count"])


@query("p17_clean_trips", sql_from("clean", _CLEAN_SQL))
def p17(spark, d):
    """The whole cleaning from text datetimes on."""
    return cleaning.clean_trips(fixtures.raw_trips(spark, d))


@query("p17_clean_trips_faulty", sql_faulty("""
, tested AS (
  SELECT *, (epoch(dropoff_datetime) - epoch(pickup_datetime))::BIGINT AS dur_s FROM faulty)
SELECT pickup_datetime, dropoff_datetime, trip_distance, passenger_count,
  {speed} AS speed_mph
FROM tested
WHERE dur_s BETWEEN 60 AND 10800 AND pickup_lat <= 40.9176::DOUBLE
  AND trip_distance BETWEEN 0.1::DOUBLE AND 100
  AND {speed} BETWEEN 1 AND 60""".format(
    speed=sql_round("trip_distance / nullif(dur_s / 3600.0::DOUBLE, 0)", 2))))
def p17_faulty(spark, d):
    return cleaning.clean_trips(fixtures.faulty_trips(spark, d)).select(
        "pickup_datetime", "dropoff_datetime", "trip_distance", "passenger_count", "speed_mph"
    )


@query("p17_clean_trips_v1", sql_from("legacy", "SELECT * EXCLUDE (dur_s) FROM legacy"))
def p17_v1(spark, d):
    return views.clean(spark, d, profiles.LEGACY)


@query("p17_clean_trips_v2", sql_from("compact", "SELECT * FROM compact"))
def p17_v2(spark, d):
    return views.clean(spark, d, profiles.COMPACT)


@query("d08_clean_trips_doc", sql_from("prepared", """
SELECT pickup_datetime, pickup_lat, pickup_lon, trip_distance, passenger_count,
  raw_speed AS speed_mph FROM prepared
WHERE pickup_lat BETWEEN 40.5::DOUBLE AND 40.95::DOUBLE
  AND pickup_lon BETWEEN -74.3::DOUBLE AND -73.7::DOUBLE
  AND dropoff_lat BETWEEN 40.5::DOUBLE AND 40.95::DOUBLE
  AND dropoff_lon BETWEEN -74.3::DOUBLE AND -73.7::DOUBLE
  AND dur_s > 0 AND dur_s < 10800 AND trip_distance > 0 AND passenger_count BETWEEN 1 AND 9"""))
def d08(spark, d):
    return views.clean(spark, d, profiles.DOCUMENTED).select(
        "pickup_datetime", "pickup_lat", "pickup_lon", "trip_distance", "passenger_count",
        "speed_mph",
    )


@query("p18_filter_pick", """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 6000""")
def p18(spark, d):
    customers = fixtures.table(spark, d, "customer")
    return customers.filter(F.col("c_acctbal") > 6000).select("c_custkey", "c_name", "c_acctbal")


@query("p18_passenger_filter", sql_from("raw", f"""
SELECT {_RAW_SQL_COLUMNS} FROM raw WHERE passenger_count > 3"""))
def p18_passengers(spark, d):
    trips = cleaning.standardize_columns(fixtures.typed_trips(spark, d)).select(*_RAW_COLUMNS)
    return trips.filter(F.col("passenger_count") > 3)


@query("p19_gps_events", sql_from("gps", "SELECT * EXCLUDE (event_ts) FROM gps"))
def p19_gps(spark, d):
    return events.gps_events(views.clean(spark, d))


@query("p19_trip_events", sql_from("trip_events", """
SELECT * EXCLUDE (event_ts) FROM trip_events"""))
def p19_trip(spark, d):
    return events.trip_events(views.clean(spark, d))


@query("p20_clamps", sql_from("prepared", """
SELECT pickup_datetime, greatest(1.0::DOUBLE, least(60.0::DOUBLE, raw_speed)) AS speed,
  greatest(40.4774::DOUBLE, least(40.9176::DOUBLE, pickup_lat)) AS pickup_lat,
  greatest(-74.2591::DOUBLE, least(-73.7004::DOUBLE, pickup_lon)) AS pickup_lon
FROM prepared"""))
def p20(spark, d):
    trips = _prepared(spark, d, profiles.COMPACT)
    pulled = cleaning.clamp_to_box(trips, "pickup_lat", "pickup_lon")
    return pulled.select(
        "pickup_datetime", clamp("speed_mph", 1.0, 60.0).alias("speed"),
        "pickup_lat", "pickup_lon",
    )


# ---- time of day --------------------------------------------------------------------------


@query("t01_hour_bucket", sql_from("prepared", """
SELECT pickup_datetime, date_trunc('hour', pickup_datetime) AS hour_bucket FROM prepared"""))
def t01(spark, d):
    return _prepared(spark, d).select(
        "pickup_datetime", temporal.hour_bucket("pickup_datetime").alias("hour_bucket")
    )


@query("t02_weekend", sql_from("prepared", """
SELECT pickup_datetime, (weekday0 >= 5)::INT AS is_weekend, (weekday0 >= 5)::INT AS weekend_monday0,
  (weekday0 >= 5)::INT AS weekend_monday1 FROM prepared"""))
def t02(spark, d):
    ts = F.col("pickup_datetime")
    flag = lambda w: temporal.is_weekend(temporal.day_number(ts, w), w)
    return _prepared(spark, d).select(
        "pickup_datetime", flag("sunday1").alias("is_weekend"),
        flag("monday0").alias("weekend_monday0"), flag("monday1").alias("weekend_monday1"),
    )


@query("t03_rush_hour", sql_from("prepared", f"""
SELECT pickup_datetime, CASE WHEN {RUSH} THEN 1 ELSE 0 END::INT AS is_rush_hour FROM prepared"""))
def t03(spark, d):
    return _prepared(spark, d).select(
        "pickup_datetime", temporal.is_rush_hour(F.hour("pickup_datetime")).alias("is_rush_hour")
    )


@query("t04_night", sql_from("prepared", """
SELECT pickup_datetime, (hour >= 22 OR hour <= 6)::INT AS is_night,
  (hour >= 22 OR hour <= 5)::INT AS is_night_v1 FROM prepared"""))
def t04(spark, d):
    hour = F.hour("pickup_datetime")
    return _prepared(spark, d).select(
        "pickup_datetime", temporal.is_night(hour).alias("is_night"),
        temporal.is_night(hour, profiles.NIGHT_END_LEGACY).alias("is_night_v1"),
    )


@query("t05_flag_to_int", sql_from("clean", """
SELECT pickup_datetime, cell_id, is_manhattan::INT AS is_manhattan_int FROM clean"""))
def t05(spark, d):
    return views.clean(spark, d).select(
        "pickup_datetime", "cell_id", F.col("is_manhattan").cast("int").alias("is_manhattan_int")
    )


@query("t06_split_column", sql_from("features", """
SELECT cell_id, hour_bucket, month, dataset_split FROM features"""))
def t06(spark, d):
    return views.feature_rows(spark, d).select("cell_id", "hour_bucket", "month", "dataset_split")


# ---- labels -------------------------------------------------------------------------------


@query("l01_label", sql_from("cells", """
SELECT cell_id, hour_bucket, avg_speed, congestion_label, congestion_level FROM cells"""))
def l01(spark, d):
    return views.labelled(spark, d).select(
        "cell_id", "hour_bucket", "avg_speed", "congestion_label", "congestion_level"
    )


def _label_query(rule):
    def build(spark, d):
        label = labels.congestion_label("avg_speed", rule)
        return views.labelled(spark, d).select(
            "cell_id", "hour_bucket", label.alias("label"),
            labels.level_name(label, rule).alias("level"),
        )
    return build


def _label_sql(first, second, low, medium, high):
    return sql_from("cells", f"""
SELECT cell_id, hour_bucket,
  CASE WHEN avg_speed {first} THEN 0 WHEN avg_speed {second} THEN 1 ELSE 2 END::INT AS label,
  CASE WHEN avg_speed {first} THEN '{low}' WHEN avg_speed {second} THEN '{medium}'
       ELSE '{high}' END AS level FROM cells""")


query("l02_label_v1", _label_sql("> 20", "> 10", "low", "medium", "high"))(
    _label_query(profiles.LABELS_LEGACY))
query("l03_label_v2", _label_sql(">= 20", ">= 10", "Low", "Medium", "High"))(
    _label_query(profiles.LABELS_COMPACT))
query("l06_window_level", _label_sql(">= 15", ">= 8", "Low", "Medium", "High"))(
    _label_query(profiles.LABELS_WINDOW))


@query("l04_speed_index", sql_from("cells", f"""
SELECT cell_id, hour_bucket, {sql_speed_index('avg_speed')} AS congestion_index
FROM cells"""))
def l04(spark, d):
    return views.labelled(spark, d).select(
        "cell_id", "hour_bucket", labels.speed_index("avg_speed").alias("congestion_index")
    )


@query("l05_piecewise_index", sql_from("cells", f"""
SELECT cell_id, hour_bucket, {sql_piecewise('avg_speed', 0.10, 0.95)} AS batch_index,
  {sql_piecewise('avg_speed', 0.05, 0.98)} AS live_index,
  {sql_level('avg_speed', 'low', 'medium', 'high', '>')} AS level FROM cells"""))
def l05(spark, d):
    return views.labelled(spark, d).select(
        "cell_id", "hour_bucket",
        labels.piecewise_index("avg_speed").alias("batch_index"),
        labels.piecewise_index("avg_speed", profiles.INDEX_CLAMP_LIVE).alias("live_index"),
        labels.piecewise_level("avg_speed").alias("level"),
    )


@query("l07_event_rule", sql_from("gps", """
SELECT event_id, level AS congestion_level,
  CASE level WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END::INT AS prediction
FROM (SELECT event_id, CASE WHEN is_rush_hour = 1 AND is_manhattan = 1 THEN 'High'
        WHEN is_rush_hour = 1 OR speed < 10 THEN 'Medium' ELSE 'Low' END AS level FROM gps)"""))
def l07(spark, d):
    scored = events.with_rule_prediction(views.gps(spark, d))
    return scored.select("event_id", "congestion_level", "prediction")


@query("l08_state_rule", sql_from("lagged", """
SELECT cell_id, hour_bucket,
  CASE WHEN avg_speed < 10 OR (avg_speed < 15 AND is_rush_hour = 1 AND is_manhattan_int = 1) THEN 2
       WHEN avg_speed < 20 THEN 1 ELSE 0 END::INT AS prediction,
  CASE WHEN avg_speed < 10 OR (avg_speed < 15 AND is_rush_hour = 1 AND is_manhattan_int = 1)
       THEN 0.82::DOUBLE WHEN avg_speed < 20 THEN 0.75::DOUBLE ELSE 0.80::DOUBLE END AS confidence,
  CASE WHEN avg_speed > 20 THEN 0 WHEN avg_speed >= 10 THEN 1 ELSE 2 END::INT AS speed_prediction,
  CASE WHEN avg_speed > 20 THEN 0.80::DOUBLE WHEN avg_speed >= 10 THEN 0.75::DOUBLE
       ELSE 0.85::DOUBLE END AS speed_confidence
FROM lagged"""))
def l08(spark, d):
    cells = with_time_flags(views.labelled(spark, d)).select(
        "cell_id", "hour_bucket",
        labels.state_rule("avg_speed", "is_rush_hour", "is_manhattan_int").alias("r"),
        labels.speed_rule("avg_speed").alias("s"),
    )
    return cells.select(
        "cell_id", "hour_bucket", "r.prediction", "r.confidence",
        F.col("s.prediction").alias("speed_prediction"),
        F.col("s.confidence").alias("speed_confidence"),
    )


@query("l09_level_to_index", sql_from("cells", """
SELECT cell_id, hour_bucket, CASE congestion_level WHEN 'Low' THEN 0.3::DOUBLE
  WHEN 'High' THEN 0.85::DOUBLE ELSE 0.55::DOUBLE END AS congestion_index FROM cells"""))
def l09(spark, d):
    return views.labelled(spark, d).select(
        "cell_id", "hour_bucket",
        labels.level_to_index("congestion_level").alias("congestion_index"),
    )


@query("l10_index_to_level", sql_from("state", """
SELECT cell_id, congestion_index, CASE WHEN congestion_index > 0.7::DOUBLE THEN 'high'
  WHEN congestion_index > 0.4::DOUBLE THEN 'medium' ELSE 'low' END AS level FROM state"""))
def l10(spark, d):
    return views.traffic_state(spark, d).select(
        "cell_id", "congestion_index", labels.index_to_level("congestion_index").alias("level")
    )


@query("l11_speed_bands", sql_from("clean", f"""
SELECT pickup_datetime, speed_mph, {sql_band('speed_mph', profiles.SPEED_BANDS)} AS band,
  {sql_band('speed_mph', profiles.SPEED_BANDS_SHORT)} AS short_band FROM clean"""))
def l11(spark, d):
    return views.clean(spark, d).select(
        "pickup_datetime", "speed_mph", band("speed_mph", profiles.SPEED_BANDS).alias("band"),
        band("speed_mph", profiles.SPEED_BANDS_SHORT).alias("short_band"),
    )


@query("l12_display_bands", sql_from("cells", f"""
SELECT cell_id, hour_bucket, {sql_band('avg_speed', profiles.SEVERITY_BANDS)} AS severity,
  {sql_band('avg_speed', profiles.DAY_BANDS)} AS day_level,
  {sql_band('avg_speed', profiles.HOUR_BANDS)} AS hour_level FROM cells"""))
def l12(spark, d):
    return views.labelled(spark, d).select(
        "cell_id", "hour_bucket", band("avg_speed", profiles.SEVERITY_BANDS).alias("severity"),
        band("avg_speed", profiles.DAY_BANDS).alias("day_level"),
        band("avg_speed", profiles.HOUR_BANDS).alias("hour_level"),
    )
