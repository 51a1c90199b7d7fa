"""Shared inputs of the registered queries and the matching SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripgrid import profiles
from tripgrid.operators import aggregates, features, state
from tripgrid.operators.cleaning import clean_trips
from tripgrid.sources import fixtures
from tripgrid.streaming import events

# ---- Spark side -------------------------------------------------------------------------


def clean(spark: SparkSession, sf_dir: str, profile=profiles.STANDARD) -> DataFrame:
    return clean_trips(fixtures.typed_trips(spark, sf_dir), profile)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.with_labels(aggregates.cell_hour(clean(spark, sf_dir)))


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_table(labelled(spark, sf_dir))


def traffic_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.traffic_state(feature_rows(spark, sf_dir))


def legacy_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = clean(spark, sf_dir, profiles.LEGACY)
    return aggregates.with_legacy_labels(aggregates.cell_hour_legacy(trips))


def gps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.with_event_time(events.gps_events(clean(spark, sf_dir)))


def trip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.with_event_time(events.trip_events(clean(spark, sf_dir)), "event_time")


# ---- SQL side ---------------------------------------------------------------------------

_TIMED = """timed AS (
  SELECT *, make_date(2016, (1 + d // 7)::BIGINT, (1 + d % 7)::BIGINT)::TIMESTAMP
            + to_seconds(sod) AS pu
  FROM (SELECT *,
          date_diff('day', DATE '1995-01-02', l_shipdate::DATE) % 21 AS d,
          (l_orderkey * 37 + l_linenumber * 1009) % 86400 AS sod,
          30 + (l_partkey * 53 + l_orderkey * 17 + l_linenumber * 101) % 3600 AS dur
        FROM lineitem))"""

_RAW = """raw AS (
  SELECT l_orderkey,
    (1 + l_linenumber % 2)::INT AS vendor_id,
    pu AS pickup_datetime,
    pu + to_seconds(dur) AS dropoff_datetime,
    (1 + l_linenumber % 4)::INT AS passenger_count,
    l_quantity / 5.0::DOUBLE AS trip_distance,
    -74.0350::DOUBLE + ((l_partkey // 7) % 14) * 0.01::DOUBLE
      + (l_orderkey % 89) * 0.0001::DOUBLE AS pickup_lon,
    40.6950::DOUBLE + (l_partkey % 7) * 0.01::DOUBLE + (l_orderkey % 97) * 0.0001::DOUBLE
      + CASE WHEN l_linenumber = 7 AND l_orderkey % 3 = 0
             THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS pickup_lat,
    -73.98::DOUBLE + (l_partkey % 50) * 0.0001::DOUBLE AS dropoff_lon,
    40.75::DOUBLE + (l_suppkey % 50) * 0.0001::DOUBLE AS dropoff_lat,
    l_extendedprice / 1000.0::DOUBLE AS fare_amount,
    l_extendedprice / 1000.0::DOUBLE * (1.0::DOUBLE + l_tax) AS total_amount
  FROM timed)"""

def sql_round(value: str, digits: int) -> str:
    """Half-up rounding of the shortest decimal text of a double, as Spark rounds doubles."""
    return f"round(({value})::VARCHAR::DECIMAL(38,18), {digits})::DOUBLE"


_PREPARED = f"""prepared AS (
  SELECT *, dur_s / 3600.0::DOUBLE AS duration_hours,
    {sql_round('trip_distance / nullif(dur_s / 3600.0::DOUBLE, 0)', 2)} AS speed_mph,
    trip_distance / nullif(dur_s / 3600.0::DOUBLE, 0) AS raw_speed,
    (pickup_lat BETWEEN 40.4774::DOUBLE AND 40.9176::DOUBLE
     AND pickup_lon BETWEEN -74.2591::DOUBLE AND -73.7004::DOUBLE
     AND dropoff_lat BETWEEN 40.4774::DOUBLE AND 40.9176::DOUBLE
     AND dropoff_lon BETWEEN -74.2591::DOUBLE AND -73.7004::DOUBLE) AS in_city,
    (pickup_lat BETWEEN 40.70::DOUBLE AND 40.88::DOUBLE
     AND pickup_lon BETWEEN -74.02::DOUBLE AND -73.93::DOUBLE) AS in_zone,
    trunc((pickup_lat - 40.4774::DOUBLE) / 0.01::DOUBLE)::INT AS cell_lat,
    trunc((pickup_lon - -74.2591::DOUBLE) / 0.01::DOUBLE)::INT AS cell_lon,
    hour(pickup_datetime)::INT AS hour,
    (dayofweek(pickup_datetime) + 1)::INT AS day_of_week,
    (isodow(pickup_datetime) - 1)::INT AS weekday0,
    month(pickup_datetime)::INT AS month,
    year(pickup_datetime)::INT AS year
  FROM (SELECT *, (epoch(dropoff_datetime) - epoch(pickup_datetime))::BIGINT AS dur_s
        FROM raw))"""

_CLEAN = """clean AS (
  SELECT *, 'cell_' || cell_lat || '_' || cell_lon AS cell_id, in_zone AS is_manhattan
  FROM prepared
  WHERE in_city AND dur_s BETWEEN 60 AND 10800
    AND trip_distance BETWEEN 0.1::DOUBLE AND 100 AND speed_mph BETWEEN 1 AND 60)"""


def sql_mean(value: str, digits: int) -> str:
    """Fixed-point mean, as ``functions.numeric.stable_avg`` computes it."""
    scale = f"1e{digits}::DOUBLE"
    return (
        f"(sum(floor(({value}) * {scale} + 0.5::DOUBLE)::BIGINT)::DOUBLE"
        f" / (count({value})::DOUBLE * {scale}))"
    )


def sql_percent(part: str, whole: str, digits: int = 1) -> str:
    return sql_round(f"({part}) * 100.0::DOUBLE / ({whole})", digits)


def sql_band(value: str, bands) -> str:
    cases = " ".join(f"WHEN {value} < {b} THEN '{n}'" for b, n in bands if b is not None)
    return f"CASE {cases} ELSE '{bands[-1][1]}' END"


def sql_level(speed: str, low="Low", medium="Medium", high="High", op2=">=") -> str:
    return f"CASE WHEN {speed} > 20 THEN '{low}' WHEN {speed} {op2} 10 THEN '{medium}' ELSE '{high}' END"


def sql_piecewise(speed: str, low: float, high: float) -> str:
    return f"""greatest({low}::DOUBLE, least({high}::DOUBLE, CASE
      WHEN {speed} > 20 THEN 0.3::DOUBLE - ({speed} - 20.0::DOUBLE) * 0.01::DOUBLE
      WHEN {speed} > 10 THEN 0.7::DOUBLE - ({speed} - 10.0::DOUBLE) * 0.04::DOUBLE
      ELSE 1.0::DOUBLE - {speed} * 0.03::DOUBLE END))"""


def sql_speed_index(speed: str) -> str:
    return f"(1.0::DOUBLE - greatest(0.0::DOUBLE, least(50.0::DOUBLE, {speed})) / 50.0::DOUBLE)"


RUSH = "(hour BETWEEN 7 AND 9 OR hour BETWEEN 17 AND 19)"

_CELLS = f"""cells AS (
  SELECT 'cell_' || cell_lat || '_' || cell_lon AS cell_id, cell_lat, cell_lon, hour_bucket,
    hour(hour_bucket)::INT AS hour, (dayofweek(hour_bucket) + 1)::INT AS day_of_week,
    month(hour_bucket)::INT AS month, year(hour_bucket)::INT AS year,
    trip_count, avg_speed, speed_std, min_speed, max_speed, avg_distance, avg_duration,
    is_manhattan,
    CASE WHEN avg_speed > 20 THEN 0 WHEN avg_speed >= 10 THEN 1 ELSE 2 END::INT
      AS congestion_label,
    {sql_level('avg_speed')} AS congestion_level
  FROM (SELECT cell_lat, cell_lon, date_trunc('hour', pickup_datetime) AS hour_bucket,
          count(*) AS trip_count,
          {sql_mean('speed_mph', 2)} AS avg_speed,
          coalesce(stddev_samp(speed_mph), 0) AS speed_std,
          min(speed_mph) AS min_speed, max(speed_mph) AS max_speed,
          {sql_mean('trip_distance', 4)} AS avg_distance,
          sum(dur_s)::DOUBLE / (count(*)::DOUBLE * 3600.0::DOUBLE) AS avg_duration,
          bool_or(is_manhattan) AS is_manhattan
        FROM clean GROUP BY ALL))"""

_LAGGED = f"""lagged AS (
  SELECT *,
    lag(trip_count, 1) OVER w AS prev_trip_count,
    lag(avg_speed, 1) OVER w AS prev_avg_speed,
    lag(congestion_label, 1) OVER w AS prev_congestion_label,
    lag(trip_count, 2) OVER w AS prev_2h_trip_count,
    lag(avg_speed, 2) OVER w AS prev_2h_avg_speed,
    (sum(trip_count) OVER h)::DOUBLE / (count(*) OVER h) AS historical_avg_trips,
    (sum(floor(avg_speed * 1e6::DOUBLE + 0.5::DOUBLE)::BIGINT) OVER h)::DOUBLE
      / ((count(*) OVER h)::DOUBLE * 1e6::DOUBLE) AS historical_avg_speed,
    CASE WHEN day_of_week IN (1, 7) THEN 1 ELSE 0 END::INT AS is_weekend,
    CASE WHEN {RUSH} THEN 1 ELSE 0 END::INT AS is_rush_hour,
    CASE WHEN hour >= 22 OR hour <= 6 THEN 1 ELSE 0 END::INT AS is_night,
    is_manhattan::INT AS is_manhattan_int
  FROM cells
  WINDOW w AS (PARTITION BY cell_lat, cell_lon ORDER BY hour_bucket),
         h AS (PARTITION BY cell_lat, cell_lon, hour))"""

_FEATURES = """features AS (
  SELECT hour, day_of_week, month, is_weekend, is_rush_hour, is_night, cell_lat, cell_lon,
    is_manhattan_int, prev_trip_count, prev_avg_speed, prev_congestion_label,
    coalesce(prev_2h_trip_count, 0) AS prev_2h_trip_count,
    coalesce(prev_2h_avg_speed, 0) AS prev_2h_avg_speed,
    historical_avg_trips, historical_avg_speed,
    congestion_label, congestion_level, avg_speed, cell_id, hour_bucket, year,
    CASE WHEN month IN (1, 2) THEN 'train' WHEN month = 3 THEN 'test' ELSE 'other' END
      AS dataset_split
  FROM lagged WHERE prev_trip_count IS NOT NULL)"""

_STATE = f"""state AS (
  SELECT 'cell_' || cell_lat || '_' || cell_lon AS cell_id,
    {sql_round('40.4855::DOUBLE + (cell_lat + 0.5::DOUBLE) * 0.0096::DOUBLE', 6)} AS latitude,
    {sql_round('-74.2567::DOUBLE + (cell_lon + 0.5::DOUBLE) * 0.009928::DOUBLE', 6)} AS longitude,
    {sql_round(sql_piecewise('speed', 0.10, 0.95), 3)} AS congestion_index,
    {sql_level('speed', 'low', 'medium', 'high', '>')} AS congestion_level,
    greatest(1, trunc(trips)::BIGINT) AS vehicle_count,
    {sql_round('speed', 1)} AS avg_speed, trunc(mean_hour)::INT AS hour,
    zone = 1 AS is_manhattan, last_update, 'batch' AS source
  FROM (SELECT cell_lat, cell_lon, {sql_mean('historical_avg_speed', 6)} AS speed,
          avg(prev_trip_count) AS trips, avg(hour) AS mean_hour,
          max(is_manhattan_int) AS zone, max(hour_bucket) AS last_update
        FROM features GROUP BY ALL))"""

_LEGACY = """legacy AS (
  SELECT pickup_datetime, dropoff_datetime, pickup_lat, pickup_lon, dropoff_lat, dropoff_lon,
    trip_distance, passenger_count, fare_amount, total_amount, duration_hours,
    raw_speed AS speed_mph, dur_s, hour, weekday0 AS day_of_week,
    CASE WHEN weekday0 IN (5, 6) THEN 1 ELSE 0 END::INT AS is_weekend, month,
    day(pickup_datetime)::INT AS day,
    trunc(pickup_lat / 0.005::DOUBLE)::INT AS cell_lat_idx,
    trunc(pickup_lon / 0.005::DOUBLE)::INT AS cell_lon_idx,
    'cell_' || trunc(pickup_lat / 0.005::DOUBLE)::INT || '_'
      || trunc(pickup_lon / 0.005::DOUBLE)::INT AS cell_id,
    (trunc(pickup_lat / 0.005::DOUBLE) + 0.5::DOUBLE) * 0.005::DOUBLE AS cell_center_lat,
    (trunc(pickup_lon / 0.005::DOUBLE) + 0.5::DOUBLE) * 0.005::DOUBLE AS cell_center_lon
  FROM prepared
  WHERE in_city AND trip_distance > 0.1::DOUBLE AND trip_distance < 100
    AND raw_speed > 0 AND raw_speed < 80)"""

_COMPACT = f"""compact AS (
  SELECT pickup_datetime, pickup_lat, pickup_lon, dropoff_lat, dropoff_lon, trip_distance,
    raw_speed AS speed_mph, hour, weekday0 AS day_of_week,
    CASE WHEN weekday0 IN (5, 6) THEN 1 ELSE 0 END::INT AS is_weekend,
    CASE WHEN {RUSH} THEN 1 ELSE 0 END::INT AS is_rush_hour,
    cell_lat || '_' || cell_lon AS cell_id, cell_lat, cell_lon
  FROM prepared
  WHERE in_city AND trip_distance > 0 AND trip_distance < 100
    AND raw_speed > 0 AND raw_speed < 60)"""

_LEGACY_CELLS = f"""legacy_cells AS (
  SELECT *,
    CASE WHEN avg_speed > 20 THEN 0 WHEN avg_speed > 10 THEN 1 ELSE 2 END::INT
      AS congestion_label,
    {sql_level('avg_speed', 'low', 'medium', 'high', '>')} AS congestion_level,
    {sql_speed_index('avg_speed')} AS congestion_index
  FROM (SELECT cell_id, date_trunc('hour', pickup_datetime) AS hour_bucket, hour, day_of_week,
          {sql_mean('pickup_lat', 6)} AS cell_lat, {sql_mean('pickup_lon', 6)} AS cell_lon,
          {sql_mean('speed_mph', 6)} AS avg_speed,
          coalesce(stddev_samp(speed_mph), 0) AS speed_std,
          min(speed_mph) AS min_speed, max(speed_mph) AS max_speed,
          count(speed_mph) AS vehicle_count,
          {sql_mean('trip_distance', 4)} AS avg_distance,
          sum(dur_s)::DOUBLE / (count(*)::DOUBLE * 3600.0::DOUBLE) AS avg_duration
        FROM legacy GROUP BY ALL))"""

_MONTHLY = f"""monthly AS (
  SELECT *, CASE WHEN avg_speed >= 20 THEN 0 WHEN avg_speed >= 10 THEN 1 ELSE 2 END::INT
      AS congestion_level
  FROM (SELECT strftime(pickup_datetime, '%Y-%m') AS file_month, cell_id, cell_lat, cell_lon,
          hour, {sql_mean('speed_mph', 6)} AS avg_speed,
          coalesce(stddev_samp(speed_mph), 0) AS speed_std, count(*) AS trip_count,
          {sql_mean('trip_distance', 4)} AS avg_distance,
          avg(is_weekend) AS weekend_ratio, avg(is_rush_hour) AS rush_hour_ratio
        FROM compact GROUP BY ALL HAVING count(*) >= 10))"""

_DIGEST = """md5(concat_ws('|', epoch(pickup_datetime)::BIGINT, epoch(dropoff_datetime)::BIGINT,
      floor(pickup_lat * 1e6::DOUBLE + 0.5::DOUBLE)::BIGINT,
      floor(pickup_lon * 1e6::DOUBLE + 0.5::DOUBLE)::BIGINT,
      floor(trip_distance * 1e4::DOUBLE + 0.5::DOUBLE)::BIGINT))"""

_GPS = f"""gps AS (
  SELECT 'evt_' || substr(digest, 1, 12) AS event_id,
    strftime(pickup_datetime, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp",
    'taxi_' || (10000 + (epoch(pickup_datetime)::BIGINT + cell_lat * 31 + cell_lon * 17) % 90000)
      AS vehicle_id,
    pickup_lat AS latitude, pickup_lon AS longitude, cell_id, cell_lat, cell_lon,
    {sql_round('greatest(0.0::DOUBLE, speed_mph)', 2)} AS speed,
    ((floor(degrees(atan2(dropoff_lon - pickup_lon, dropoff_lat - pickup_lat)))::BIGINT % 360
      + 360) % 360)::INT AS heading,
    'trip_' || substr(digest, 13, 8) AS trip_id,
    hour, day_of_week,
    CASE WHEN day_of_week IN (1, 7) THEN 1 ELSE 0 END::INT AS is_weekend,
    CASE WHEN {RUSH} THEN 1 ELSE 0 END::INT AS is_rush_hour,
    CASE WHEN hour >= 22 OR hour <= 5 THEN 1 ELSE 0 END::INT AS is_night,
    in_zone::INT AS is_manhattan,
    pickup_datetime AS event_ts
  FROM (SELECT *, {_DIGEST} AS digest FROM clean))"""

_TRIP_EVENTS = f"""trip_events AS (
  SELECT 'replay_' || substr({_DIGEST}, 1, 16) AS event_id,
    strftime(pickup_datetime, '%Y-%m-%dT%H:%M:%S') AS event_time,
    strftime(pickup_datetime, '%Y-%m-%dT%H:%M:%S') AS pickup_datetime,
    strftime(dropoff_datetime, '%Y-%m-%dT%H:%M:%S') AS dropoff_datetime,
    pickup_lat, pickup_lon, dropoff_lat, dropoff_lon, trip_distance,
    {sql_round('duration_hours * 60.0::DOUBLE', 2)} AS duration_minutes,
    greatest(1.0::DOUBLE, least(60.0::DOUBLE, speed_mph)) AS speed_mph,
    passenger_count, fare_amount,
    cell_lat || '_' || cell_lon AS cell_id, cell_lat, cell_lon, hour,
    weekday0 + 1 AS day_of_week, month, year,
    CASE WHEN weekday0 >= 5 THEN 1 ELSE 0 END::INT AS is_weekend,
    CASE WHEN {RUSH} THEN 1 ELSE 0 END::INT AS is_rush_hour,
    CASE WHEN hour >= 22 OR hour <= 5 THEN 1 ELSE 0 END::INT AS is_night,
    (pickup_lat BETWEEN 40.70::DOUBLE AND 40.82::DOUBLE
     AND pickup_lon BETWEEN -74.02::DOUBLE AND -73.93::DOUBLE)::INT AS is_manhattan,
    clean.pickup_datetime AS event_ts
  FROM clean)"""

_PARTS = {
    "timed": _TIMED, "raw": _RAW, "prepared": _PREPARED, "clean": _CLEAN, "cells": _CELLS,
    "lagged": _LAGGED, "features": _FEATURES, "state": _STATE, "legacy": _LEGACY,
    "compact": _COMPACT, "legacy_cells": _LEGACY_CELLS, "monthly": _MONTHLY, "gps": _GPS,
    "trip_events": _TRIP_EVENTS,
}
_NEEDS = {
    "timed": (), "raw": ("timed",), "prepared": ("raw",), "clean": ("prepared",),
    "cells": ("clean",), "lagged": ("cells",), "features": ("lagged",), "state": ("features",),
    "legacy": ("prepared",), "compact": ("prepared",), "legacy_cells": ("legacy",),
    "monthly": ("compact",), "gps": ("clean",), "trip_events": ("clean",),
}


def sql_from(view: str, body: str, *more: str) -> str:
    """``body`` behind the common table expressions of ``view`` and of ``more``."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for parent in _NEEDS[name]:
            need(parent)
        if name not in ordered:
            ordered.append(name)

    for name in (view, *more):
        need(name)
    return "WITH " + ",\n".join(_PARTS[n] for n in ordered) + "\n" + body.strip()
