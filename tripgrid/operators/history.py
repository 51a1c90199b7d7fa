"""Cell history kept up month by month.

A month is reduced to sums that can be added: per cell and hour of the day the number of hours,
their trips and their speeds in fixed point, and per cell its newest two hours. A month's rows are
replaced as a whole and alone, so adding one reads that month's trips only, and running it twice
changes nothing. The history of all months is the sum of a table with at most cells x 24 rows a
month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrid.functions.numeric import fixed_point
from tripgrid.operators.features import with_lags

_CELL = ["cell_lat", "cell_lon"]
_MONTH = ["year", "month"]


def month_sums(cells: DataFrame) -> DataFrame:
    """Per cell, hour of the day and month: hours seen, trips and speeds, from labelled cell hours."""
    return cells.groupBy(*_CELL, "hour", *_MONTH).agg(
        F.count(F.lit(1)).alias("hours"),
        F.sum("trip_count").alias("trips"),
        F.sum(fixed_point("avg_speed", 6)).alias("speed_units"),
    )


def month_newest(cells: DataFrame) -> DataFrame:
    """Per cell and month its newest two hours."""
    # the two largest of a cell's hours are merged in each task, so a group never holds its rows
    row = F.struct("hour_bucket", "trip_count", "avg_speed", "congestion_label")
    first = cells.groupBy(*_CELL, *_MONTH).agg(F.max(row).alias("newest"))
    again = cells.join(first.select(*_CELL, *_MONTH, F.col("newest.hour_bucket").alias("_at")), [*_CELL, *_MONTH])
    second = again.filter("hour_bucket < _at").groupBy(*_CELL, *_MONTH).agg(F.max(row).alias("newest"))
    return first.unionByName(second).select(*_CELL, *_MONTH, "newest.*")


def add_months(cells: DataFrame, path: str) -> None:
    """Writes the months of ``cells`` below ``path``; other months stay as they are."""
    for name, table in (("sums", month_sums(cells)), ("newest", month_newest(cells))):
        writer = table.repartition(*_MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*_MONTH).parquet(f"{path}/{name}")


def hourly_means(spark: SparkSession, path: str) -> DataFrame:
    """Historical trips and speed per cell and hour of the day, over all months."""
    total = spark.read.parquet(f"{path}/sums").groupBy(*_CELL, "hour").agg(
        F.sum("hours").alias("n"), F.sum("trips").alias("trips"), F.sum("speed_units").alias("units")
    )
    n = F.col("n").cast("double")
    return total.select(
        *_CELL, "hour",
        (F.col("trips").cast("double") / n).alias("historical_avg_trips"),
        (F.col("units").cast("double") / (n * 1e6)).alias("historical_avg_speed"),
    )


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    """What ``enrich.history_snapshot`` gives for all cell hours, from the months' sums."""
    newest = with_lags(spark.read.parquet(f"{path}/newest")).groupBy(*_CELL).agg(
        F.max_by(
            F.struct(
                F.col("trip_count").alias("prev_trip_count"),
                F.col("avg_speed").alias("prev_avg_speed"),
                F.col("congestion_label").alias("prev_congestion_label"),
                F.col("prev_trip_count").alias("prev_2h_trip_count"),
                F.col("prev_avg_speed").alias("prev_2h_avg_speed"),
            ),
            "hour_bucket",
        ).alias("n")
    )
    hours = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")
    return newest.select(*_CELL, hours, "n.*").join(hourly_means(spark, path), [*_CELL, "hour"], "left")
