"""Windowed aggregates, written once for batch and streaming frames.

``withWatermark`` has no effect on a batch frame, so the batch result is the full answer
the streaming result converges to. State is one row per open window and key: partial
aggregates, never the events themselves.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrid import profiles
from tripgrid.functions import labels
from tripgrid.functions.numeric import stable_avg

CELL_KEYS = ("cell_id", "cell_lat", "cell_lon")
LATENESS = "2 minutes"


def window_aggregates(
    events: DataFrame,
    size: str = "1 minute",
    speed: str = "speed",
    keys: tuple[str, ...] = CELL_KEYS,
    extra_means: dict[str, str] | None = None,
    with_std: bool = False,
    lateness: str = LATENESS,
) -> DataFrame:
    """Count, mean, maximum and minimum speed and level per tumbling window and key."""
    measures = [
        F.count(F.lit(1)).alias("trip_count"),
        stable_avg(speed).alias("avg_speed"),
        F.max(speed).alias("max_speed"),
        F.min(speed).alias("min_speed"),
    ]
    if with_std:
        measures.append(F.coalesce(F.stddev_samp(speed), F.lit(0.0)).alias("speed_std"))
    measures += [stable_avg(c, 6).alias(name) for name, c in (extra_means or {}).items()]
    names = ["trip_count", "avg_speed", "max_speed", "min_speed"]
    names += (["speed_std"] if with_std else []) + list(extra_means or {})
    grouped = (
        events.withWatermark("event_ts", lateness)
        .groupBy(F.window("event_ts", size).alias("w"), *keys)
        .agg(*measures)
    )
    return grouped.select(
        *keys, *names,
        labels.window_level("avg_speed").alias("congestion_level"),
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
    )


def trip_window_aggregates(events: DataFrame, size: str = "1 minute") -> DataFrame:
    """Window aggregates of full trip events, with mean distance and fare."""
    return window_aggregates(
        events, size, "speed_mph",
        extra_means={"avg_distance": "trip_distance", "avg_fare": "fare_amount"},
    )


def congestion_alerts(windows: DataFrame) -> DataFrame:
    return windows.filter(F.col("congestion_level") == "High")


def live_state(events: DataFrame, size: str = "5 seconds", lateness: str = LATENESS) -> DataFrame:
    """State records per short window and cell; the earliest event gives the position.

    Equal times go to the smallest latitude, then longitude. Time and position (to 1e-7 degrees)
    are packed into one number, so the raw events are aggregated by hash and never sorted.
    """
    degrees = lambda name, shift: F.floor((F.col(name) + shift) * 1e7)
    place = degrees("latitude", 90.0) * 4_000_000_000 + degrees("longitude", 180.0)
    number = lambda c: c.cast("decimal(38,0)")
    moment = number(F.unix_micros("event_ts")) * F.lit(Decimal(10**19))
    order = number(moment + number(F.coalesce(place, F.lit(-1))))
    earliest = lambda name: F.min_by(name, order)
    grouped = (
        events.withWatermark("event_ts", lateness)
        .groupBy(F.window("event_ts", size).alias("w"), "cell_id")
        .agg(
            stable_avg("speed").alias("speed"),
            F.count(F.lit(1)).alias("vehicle_count"),
            F.avg("hour").alias("mean_hour"),
            earliest("latitude").alias("first_lat"),
            earliest("longitude").alias("first_lon"),
            earliest("is_manhattan").alias("first_zone"),
        )
    )
    return grouped.select(
        "cell_id",
        F.round("first_lat", 6).alias("latitude"),
        F.round("first_lon", 6).alias("longitude"),
        F.round(labels.piecewise_index("speed", profiles.INDEX_CLAMP_LIVE), 3)
        .alias("congestion_index"),
        labels.piecewise_level("speed").alias("congestion_level"),
        "vehicle_count",
        F.round("speed", 1).alias("avg_speed"),
        F.col("mean_hour").cast("int").alias("hour"),
        (F.col("first_zone") == 1).alias("is_manhattan"),
        F.col("w.end").alias("last_update"),
        F.lit("live").alias("source"),
    )


def second_counts(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Events per second and cell, on batch frames and streams alike."""
    second = F.window("event_ts", "1 second").alias("w")
    counts = events.withWatermark("event_ts", lateness).groupBy(second, "cell_id").agg(
        F.count(F.lit(1)).alias("events")
    )
    return counts.select(F.col("w.start").alias("second"), "cell_id", "events")


def event_rate(counts: DataFrame) -> DataFrame:
    """Events and distinct active cells per second, exactly, from ``second_counts``.

    For stored counts; ``chained_event_rate`` does both in one streaming query.
    """
    return counts.groupBy("second").agg(
        F.sum("events").alias("events_per_second"), F.count(F.lit(1)).alias("active_cells")
    )


def chained_event_rate(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Like ``event_rate`` in one streaming query, exactly: two aggregations one after the other.

    The first has a row per second and cell, the second adds up the rows of a second once the
    watermark has closed them. For append mode; state is one row per open second and cell.
    """
    per_cell = (
        events.withWatermark("event_ts", lateness)
        .groupBy(F.window("event_ts", "1 second").alias("w"), "cell_id")
        .agg(F.count(F.lit(1)).alias("events"))
    )
    rates = per_cell.groupBy(F.window(F.window_time("w"), "1 second").alias("s")).agg(
        F.sum("events").alias("events_per_second"), F.count(F.lit(1)).alias("active_cells")
    )
    return rates.select(F.col("s.start").alias("second"), "events_per_second", "active_cells")


def approximate_event_rate(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Like ``event_rate`` in one streaming query; cells are estimated to about one per cent."""
    rates = (
        events.withWatermark("event_ts", lateness)
        .groupBy(F.window("event_ts", "1 second").alias("w"))
        .agg(
            F.count(F.lit(1)).alias("events_per_second"),
            F.approx_count_distinct("cell_id", 0.01).alias("active_cells"),
        )
    )
    return rates.select(F.col("w.start").alias("second"), "events_per_second", "active_cells")
