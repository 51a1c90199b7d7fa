"""Event payloads: clean trips to events, events to messages and back.

All of it is projection, the same on batch and streaming frames. Ids, vehicle numbers and
headings follow from the trip, so replaying a trip gives the same event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripgrid import profiles
from tripgrid.functions import grid, labels, temporal
from tripgrid.functions.frames import compute_once
from tripgrid.functions.numeric import clamp, fixed_point
from tripgrid.schemas import GPS_EVENT, TRIP_EVENT


def trip_digest() -> Column:
    """Hex digest of a trip's times, pickup point and distance in whole units."""
    return F.md5(F.concat_ws(
        "|",
        F.unix_timestamp("pickup_datetime"),
        F.unix_timestamp("dropoff_datetime"),
        fixed_point("pickup_lat", 6),
        fixed_point("pickup_lon", 6),
        fixed_point("trip_distance", 4),
    ))


def _vehicle_number() -> Column:
    mixed = F.unix_timestamp("pickup_datetime") + F.col("cell_lat") * 31 + F.col("cell_lon") * 17
    return 10000 + mixed % 90000


def _heading() -> Column:
    """Compass bearing from pickup to dropoff on the flat grid, whole degrees."""
    east = F.col("dropoff_lon") - F.col("pickup_lon")
    north = F.col("dropoff_lat") - F.col("pickup_lat")
    return F.pmod(F.floor(F.degrees(F.atan2(east, north))), F.lit(360)).cast("int")


def gps_events(trips: DataFrame) -> DataFrame:
    """One position event per clean trip, at its pickup."""
    digest = trip_digest()
    day = F.col("day_of_week")
    return trips.select(
        F.concat(F.lit("evt_"), F.substring(digest, 1, 12)).alias("event_id"),
        temporal.iso_text("pickup_datetime", zulu=True).alias("timestamp"),
        F.concat(F.lit("taxi_"), _vehicle_number().cast("string")).alias("vehicle_id"),
        F.col("pickup_lat").alias("latitude"),
        F.col("pickup_lon").alias("longitude"),
        "cell_id", "cell_lat", "cell_lon",
        F.round(clamp("speed_mph", low=0.0), 2).alias("speed"),
        _heading().alias("heading"),
        F.concat(F.lit("trip_"), F.substring(digest, 13, 8)).alias("trip_id"),
        "hour", "day_of_week",
        temporal.is_weekend(day).alias("is_weekend"),
        temporal.is_rush_hour("hour").alias("is_rush_hour"),
        temporal.is_night("hour", profiles.NIGHT_END_LEGACY).alias("is_night"),
        profiles.ZONE_BOX.contains("pickup_lat", "pickup_lon").cast("int").alias("is_manhattan"),
    )


def trip_events(trips: DataFrame) -> DataFrame:
    """One full trip event per clean trip; cell ids carry no prefix, weekdays count from Monday."""
    ts = F.col("pickup_datetime")
    day = temporal.day_number(ts, "monday1")
    return trips.select(
        F.concat(F.lit("replay_"), F.substring(trip_digest(), 1, 16)).alias("event_id"),
        temporal.iso_text(ts).alias("event_time"),
        temporal.iso_text(ts).alias("pickup_datetime"),
        temporal.iso_text("dropoff_datetime").alias("dropoff_datetime"),
        "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon", "trip_distance",
        F.round(F.col("duration_hours") * 60.0, 2).alias("duration_minutes"),
        clamp("speed_mph", 1.0, 60.0).alias("speed_mph"),
        F.coalesce("passenger_count", F.lit(1)).alias("passenger_count"),
        F.coalesce("fare_amount", F.lit(10.0)).alias("fare_amount"),
        grid.cell_id("cell_lat", "cell_lon", None).alias("cell_id"),
        "cell_lat", "cell_lon",
        F.hour(ts).alias("hour"),
        day.alias("day_of_week"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        temporal.is_weekend(day, "monday1").alias("is_weekend"),
        temporal.is_rush_hour(F.hour(ts)).alias("is_rush_hour"),
        temporal.is_night(F.hour(ts), profiles.NIGHT_END_LEGACY).alias("is_night"),
        profiles.STREAM_ZONE_BOX.contains("pickup_lat", "pickup_lon").cast("int")
        .alias("is_manhattan"),
    )


def to_messages(df: DataFrame, key: str = "cell_id") -> DataFrame:
    """Key and JSON value of every row, as a message sink takes them."""
    return df.select(F.col(key).alias("key"), F.to_json(F.struct("*")).alias("value"))


def parse_messages(messages: DataFrame, schema: StructType = GPS_EVENT) -> DataFrame:
    """Fields of JSON messages beside their key and broker time.

    Text that is no JSON gives a row of nulls, as the broker key may still be of use.

    The JSON reader is no generated code, and whatever is folded into its argument is interpreted
    node by node for each row; so the text is made before it, as a column of its own.
    """
    broker_time = (
        F.col("timestamp") if "timestamp" in messages.columns
        else F.lit(None).cast("timestamp")
    )
    texts = messages.select(
        F.col("key").cast("string").alias("message_key"),
        broker_time.alias("message_time"),
        F.col("value").cast("string").alias("value"),
    )
    return compute_once(texts, ["value"]).select(
        "message_key", "message_time", F.from_json("value", schema).alias("d")
    ).select("message_key", "message_time", "d.*")


def with_event_time(events: DataFrame, text: str = "timestamp") -> DataFrame:
    return events.withColumn("event_ts", temporal.from_iso_text(text))


def with_rule_prediction(events: DataFrame, speed: str = "speed") -> DataFrame:
    level = labels.event_level(speed)
    return events.withColumn("congestion_level", level).withColumn(
        "prediction", labels.level_code("congestion_level")
    )

