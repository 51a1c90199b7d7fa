"""Explicit schemas of the raw file, the two event payloads and the stored state."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType()}


def _schema(text: str) -> T.StructType:
    """Nullable fields from ``name type`` pairs; unlike DDL parsing this needs no session."""
    fields = [field.split() for field in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


RAW_TRIP = _schema("""
    VendorID int, tpep_pickup_datetime string, tpep_dropoff_datetime string,
    passenger_count int, trip_distance double,
    pickup_longitude double, pickup_latitude double,
    RatecodeID int, store_and_fwd_flag string,
    dropoff_longitude double, dropoff_latitude double,
    payment_type int, fare_amount double, extra double, mta_tax double,
    tip_amount double, tolls_amount double, improvement_surcharge double,
    total_amount double
""")

GPS_EVENT = _schema("""
    event_id string, timestamp string, vehicle_id string,
    latitude double, longitude double,
    cell_id string, cell_lat int, cell_lon int,
    speed double, heading int, trip_id string,
    hour int, day_of_week int, is_weekend int, is_rush_hour int, is_night int,
    is_manhattan int
""")

TRIP_EVENT = _schema("""
    event_id string, event_time string, pickup_datetime string, dropoff_datetime string,
    pickup_lat double, pickup_lon double, dropoff_lat double, dropoff_lon double,
    trip_distance double, duration_minutes double, speed_mph double,
    passenger_count int, fare_amount double,
    cell_id string, cell_lat int, cell_lon int,
    hour int, day_of_week int, month int, year int,
    is_weekend int, is_rush_hour int, is_night int, is_manhattan int
""")

# raw vendor column -> standard name
STANDARD_NAMES = {
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "pickup_longitude": "pickup_lon",
    "pickup_latitude": "pickup_lat",
    "dropoff_longitude": "dropoff_lon",
    "dropoff_latitude": "dropoff_lat",
}
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
