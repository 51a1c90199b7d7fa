"""Cell and hour aggregates.

Trips reach every shuffle here as partial aggregates: a map task sends at most one row per
group, so a cell holding a third of all trips costs one row per task, not a third of the
data. Later stages run on the aggregated tables, whose size follows cells x hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgrid import profiles
from tripgrid.functions import grid, labels, temporal
from tripgrid.functions.numeric import percent_of, stable_avg

SPEED_DIGITS = 2
RAW_SPEED_DIGITS = 6
DISTANCE_DIGITS = 4


def _mean_seconds_as_hours() -> Column:
    """Mean duration, summed in whole seconds."""
    seconds = F.floor(F.col("duration_hours") * 3600.0 + 0.5)
    return F.try_divide(
        F.sum(seconds).cast("double"), F.count("duration_hours").cast("double") * 3600.0
    )


def cell_hour(trips: DataFrame, prefix: str | None = "cell") -> DataFrame:
    """Trips per cell and hour with speed, distance and duration measures.

    The calendar columns and the cell id follow from the three grouping keys, so they are
    derived after the shuffle instead of being carried through it. The zone flag of a cell
    straddling the zone edge is the maximum, which does not depend on row order.
    """
    hours = trips.groupBy(
        "cell_lat", "cell_lon", temporal.hour_bucket("pickup_datetime").alias("hour_bucket")
    ).agg(
        F.count(F.lit(1)).alias("trip_count"),
        stable_avg("speed_mph", SPEED_DIGITS).alias("avg_speed"),
        F.coalesce(F.stddev_samp("speed_mph"), F.lit(0.0)).alias("speed_std"),
        F.min("speed_mph").alias("min_speed"),
        F.max("speed_mph").alias("max_speed"),
        stable_avg("trip_distance", DISTANCE_DIGITS).alias("avg_distance"),
        _mean_seconds_as_hours().alias("avg_duration"),
        F.max("is_manhattan").alias("is_manhattan"),
    )
    bucket = F.col("hour_bucket")
    return hours.select(
        grid.cell_id("cell_lat", "cell_lon", prefix).alias("cell_id"),
        "cell_lat",
        "cell_lon",
        "hour_bucket",
        F.hour(bucket).alias("hour"),
        F.dayofweek(bucket).alias("day_of_week"),
        F.month(bucket).alias("month"),
        F.year(bucket).alias("year"),
        "trip_count", "avg_speed", "speed_std", "min_speed", "max_speed",
        "avg_distance", "avg_duration", "is_manhattan",
    )


def with_labels(cells: DataFrame, rule=profiles.LABELS) -> DataFrame:
    return cells.withColumn(
        "congestion_label", labels.congestion_label("avg_speed", rule)
    ).withColumn("congestion_level", labels.level_name("congestion_label", rule))


def cell_hour_legacy(trips: DataFrame) -> DataFrame:
    """Cell x hour of the 0.005 degree grid; the mean pickup position stands for the cell."""
    hours = trips.groupBy(
        "cell_id", temporal.hour_bucket("pickup_datetime").alias("hour_bucket")
    ).agg(
        stable_avg("pickup_lat", 6).alias("cell_lat"),
        stable_avg("pickup_lon", 6).alias("cell_lon"),
        stable_avg("speed_mph", RAW_SPEED_DIGITS).alias("avg_speed"),
        F.coalesce(F.stddev_samp("speed_mph"), F.lit(0.0)).alias("speed_std"),
        F.min("speed_mph").alias("min_speed"),
        F.max("speed_mph").alias("max_speed"),
        F.count("speed_mph").alias("vehicle_count"),
        stable_avg("trip_distance", DISTANCE_DIGITS).alias("avg_distance"),
        _mean_seconds_as_hours().alias("avg_duration"),
    )
    bucket = F.col("hour_bucket")
    return hours.select(
        "cell_id", "hour_bucket",
        F.hour(bucket).alias("hour"), F.weekday(bucket).alias("day_of_week"),
        "cell_lat", "cell_lon",
        "avg_speed", "speed_std", "min_speed", "max_speed", "vehicle_count",
        "avg_distance", "avg_duration",
    )


def with_legacy_labels(cells: DataFrame) -> DataFrame:
    return with_labels(cells, profiles.LABELS_LEGACY).withColumn(
        "congestion_index", labels.speed_index("avg_speed")
    )


def cell_hour_of_day(trips: DataFrame, min_trips: int = 10) -> DataFrame:
    """Per source month, cell and hour of day; groups below ``min_trips`` are left out.

    The second-level cell profile reads one file per month; here the month is a key.
    """
    return (
        trips.groupBy(
            F.date_format("pickup_datetime", "yyyy-MM").alias("file_month"),
            "cell_id", "cell_lat", "cell_lon", "hour",
        )
        .agg(
            stable_avg("speed_mph", RAW_SPEED_DIGITS).alias("avg_speed"),
            F.coalesce(F.stddev_samp("speed_mph"), F.lit(0.0)).alias("speed_std"),
            F.count("speed_mph").alias("trip_count"),
            stable_avg("trip_distance", DISTANCE_DIGITS).alias("avg_distance"),
            F.avg("is_weekend").alias("weekend_ratio"),
            F.avg("is_rush_hour").alias("rush_hour_ratio"),
        )
        .filter(F.col("trip_count") >= min_trips)
        .withColumn(
            "congestion_level", labels.congestion_label("avg_speed", profiles.LABELS_COMPACT)
        )
    )


def cell_hour_profile(monthly: DataFrame) -> DataFrame:
    """Months merged: unweighted mean of the monthly means, summed counts, new label."""
    box = profiles.ZONE_CELL_BOX
    means = ("avg_speed", "speed_std", "avg_distance", "weekend_ratio", "rush_hour_ratio")
    merged = monthly.groupBy("cell_id", "hour").agg(
        *[stable_avg(n, RAW_SPEED_DIGITS).alias(n) for n in means],
        F.sum("trip_count").alias("trip_count"),
        F.min("cell_lat").alias("cell_lat"),
        F.min("cell_lon").alias("cell_lon"),
    )
    return merged.withColumns({
        "congestion_level": labels.congestion_label("avg_speed", profiles.LABELS_COMPACT),
        "is_manhattan": box.contains("cell_lat", "cell_lon").cast("int"),
    })


def cell_statistics(cells: DataFrame) -> DataFrame:
    """Typical values per cell and its most frequent label, the smallest one on ties.

    Three counters stand for the mode: their buffer has a fixed size, where a generic mode
    keeps a map of values per group.
    """
    counter = lambda label: F.count_if(F.col("congestion_label") == label)
    stats = cells.groupBy("cell_id").agg(
        F.min_by("cell_lat", "hour_bucket").alias("latitude"),
        F.min_by("cell_lon", "hour_bucket").alias("longitude"),
        stable_avg("avg_speed", 6).alias("typical_speed"),
        F.avg("vehicle_count").alias("typical_vehicle_count"),
        stable_avg("congestion_index", 6).alias("typical_congestion"),
        *[counter(label).alias(f"_n{label}") for label in (0, 1, 2)],
    )
    low, medium, high = F.col("_n0"), F.col("_n1"), F.col("_n2")
    mode = F.when(low >= F.greatest(medium, high), 0).when(medium >= high, 1).otherwise(2)
    return stats.withColumn("dominant_congestion_level", mode).withColumn(
        "dominant_congestion",
        labels.level_name("dominant_congestion_level", profiles.LABELS_LEGACY),
    ).drop("_n0", "_n1", "_n2")


def trip_statistics(trips: DataFrame) -> DataFrame:
    """Row count, distinct cells and speed range in one pass."""
    return trips.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("cell_lat", "cell_lon").alias("unique_cells"),
        F.min("speed_mph").alias("min_speed"),
        F.max("speed_mph").alias("max_speed"),
        stable_avg("speed_mph", SPEED_DIGITS).alias("avg_speed"),
    )


def trips_by_hour(trips: DataFrame) -> DataFrame:
    return trips.groupBy("hour").agg(F.count(F.lit(1)).alias("trip_count")).orderBy("hour")


def date_range(cells: DataFrame) -> DataFrame:
    return cells.agg(
        F.min("hour_bucket").alias("first_bucket"), F.max("hour_bucket").alias("last_bucket")
    )


def distribution(df: DataFrame, *keys: str, digits: int = 1) -> DataFrame:
    """Rows per key with their percentage of all rows.

    The total is a window over the grouped rows, never over the input.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    total = F.sum("row_count").over(Window.partitionBy())
    return counts.withColumn("percent", percent_of("row_count", total, digits)).orderBy(*keys)
