"""Lag, history and training tables on top of the cell x hour aggregate.

Windows partition by cell. Their input has one row per cell and hour, so the largest
group is bounded by the hours covered (8,784 a year), not by the trips of a busy cell.
The history window partitions by (cell, hour), a superset of the lag window's keys, so it
reuses the lag window's exchange and only sorts again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgrid import profiles
from tripgrid.functions import temporal
from tripgrid.functions.numeric import stable_avg_over

_CELL = ("cell_lat", "cell_lon")
_LAGS = {
    "prev_trip_count": ("trip_count", 1),
    "prev_avg_speed": ("avg_speed", 1),
    "prev_congestion_label": ("congestion_label", 1),
    "prev_2h_trip_count": ("trip_count", 2),
    "prev_2h_avg_speed": ("avg_speed", 2),
}


def with_lags(cells: DataFrame, strict_hour: bool = False) -> DataFrame:
    """Values of the previous one and two rows of the cell.

    By default a lag counts rows, so it skips hours without trips. ``strict_hour`` takes
    the row exactly one or two hours earlier and leaves null where there is none.
    """
    by_cell = Window.partitionBy(*_CELL)
    if strict_hour:
        by_time = by_cell.orderBy(F.unix_timestamp("hour_bucket"))
        lagged = {
            name: F.max(source).over(by_time.rangeBetween(-3600 * n, -3600 * n))
            for name, (source, n) in _LAGS.items()
        }
    else:
        by_time = by_cell.orderBy("hour_bucket")
        lagged = {name: F.lag(source, n).over(by_time) for name, (source, n) in _LAGS.items()}
    return cells.withColumns(lagged)


def with_history(cells: DataFrame) -> DataFrame:
    """Means over all rows of the same cell and hour of day, this row included."""
    same_hour = Window.partitionBy(*_CELL, "hour")
    return cells.withColumns({
        "historical_avg_trips": F.avg("trip_count").over(same_hour),
        "historical_avg_speed": stable_avg_over("avg_speed", same_hour),
    })


def with_time_flags(cells: DataFrame) -> DataFrame:
    return cells.withColumns({
        "is_weekend": temporal.is_weekend("day_of_week"),
        "is_rush_hour": temporal.is_rush_hour("hour"),
        "is_night": temporal.is_night("hour"),
        "is_manhattan_int": F.col("is_manhattan").cast("int"),
    })


def with_split(df: DataFrame) -> DataFrame:
    return df.withColumn("dataset_split", temporal.dataset_split("month"))


def feature_table(cells: DataFrame, strict_hour: bool = False) -> DataFrame:
    """16 features, 3 targets, 3 metadata columns and the split, from labelled cell hours.

    Rows without one-row lags are dropped; a missing two-row lag becomes 0. The history
    means include the current row and later months: they are kept so because the published
    models were trained on them.
    """
    df = with_time_flags(with_history(with_lags(cells, strict_hour)))
    df = df.na.drop(subset=["prev_trip_count", "prev_avg_speed", "prev_congestion_label"])
    df = df.select(
        *profiles.FEATURE_COLUMNS, *profiles.TARGET_COLUMNS, *profiles.METADATA_COLUMNS
    )
    return with_split(df.na.fill(0))


def temporal_split(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by date; an empty side is an error, as no model can be judged."""
    split = F.col("dataset_split")
    sides = features.filter(split == "train"), features.filter(split == "test")
    for name, side in zip(("train", "test"), sides):
        if side.isEmpty():
            raise ValueError(f"the {name} side of the split by date is empty: use hash_split")
    return sides


def hash_split(
    features: DataFrame, share: float = 0.8, keys: tuple[str, ...] = ("cell_id", "hour_bucket")
) -> tuple[DataFrame, DataFrame]:
    """Two sides by a hash of the keys, the first with about ``share`` of the rows.

    A row's side depends on its keys alone: sides never overlap or miss a row, whatever the
    partitions, and a retried task draws the same rows.
    """
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    first = draw < F.lit(int(share * 2**32))
    return features.filter(first), features.filter(~first)


def variation(std: Column | str, mean: Column | str) -> Column:
    """Coefficient of variation, 0 where the mean is 0."""
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.try_divide(as_col(std), as_col(mean)), F.lit(0.0))


def legacy_features(cells: DataFrame) -> DataFrame:
    """Time flags, spread and density features of the 0.005 degree aggregate.

    Density divides by the largest count of the whole table. The maximum is an uncorrelated
    scalar subquery, evaluated once, so the table is neither joined nor gathered.
    """
    busiest = cells.agg(F.max("vehicle_count").alias("m"))
    df = cells.withColumns({
        "is_rush_hour": temporal.is_rush_hour("hour"),
        "is_night": temporal.is_night("hour", profiles.NIGHT_END_LEGACY),
        "is_weekend": temporal.is_weekend("day_of_week", "monday0"),
        "speed_coefficient_var": variation("speed_std", "avg_speed"),
        "speed_range": F.col("max_speed") - F.col("min_speed"),
        "density_score": F.col("vehicle_count").cast("double") / busiest.scalar(),
    })
    return df.withColumn("rush_hour_density", F.col("is_rush_hour") * F.col("density_score"))


def legacy_training_table(cells: DataFrame) -> DataFrame:
    """12 features and the label; rows with any missing value are dropped."""
    return cells.select(
        *profiles.LEGACY_FEATURE_COLUMNS, "congestion_label", "cell_id", "hour_bucket"
    ).na.drop()


def rolling_means(cells: DataFrame, hours=(3, 6, 24), value: str = "avg_speed") -> DataFrame:
    """Mean of ``value`` over the last n hours of the cell, this hour included."""
    by_time = Window.partitionBy(*_CELL).orderBy(F.unix_timestamp("hour_bucket"))
    return cells.withColumns({
        f"{value}_{n}h": stable_avg_over(value, by_time.rangeBetween(-3600 * (n - 1), 0))
        for n in hours
    })
