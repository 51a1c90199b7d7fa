"""Trip analyses: profiles, hotspots, histograms, quantiles and extremes."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgrid import profiles
from tripgrid.functions import labels, temporal
from tripgrid.functions.numeric import band, fixed_point, percent_of, stable_avg
from tripgrid.operators import quantiles
from tripgrid.operators.quantiles import exact_quantiles, ordered_form

# Day names by Spark's numbering, 1 = Sunday.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def moving(trips: DataFrame) -> DataFrame:
    return trips.filter(F.col("speed_mph") > 0)


def speed_by_hour(trips: DataFrame) -> DataFrame:
    """Mean speed per hour of day, rounded to 2 decimals, with its level."""
    hours = moving(trips).groupBy("hour").agg(
        F.round(stable_avg("speed_mph"), 2).alias("avg_speed")
    )
    return hours.withColumn("level", band("avg_speed", profiles.HOUR_BANDS)).orderBy("hour")


def slow_hours(trips: DataFrame, below: float = 15.0) -> DataFrame:
    return speed_by_hour(trips).filter(F.col("avg_speed") < below)


def top_k(df: DataFrame, k: int, *order: Column, rank: str = "rank") -> DataFrame:
    """First ``k`` rows by ``order`` with their rank.

    The limit comes before the window, so only ``k`` rows meet in one task.
    """
    return df.orderBy(*order).limit(k).withColumn(
        rank, F.row_number().over(Window.orderBy(*order))
    )


def busiest_cells(trips: DataFrame, k: int = 20) -> DataFrame:
    counts = trips.groupBy("cell_id").agg(F.count(F.lit(1)).alias("trip_count"))
    return top_k(counts, k, F.desc("trip_count"), F.col("cell_id"))


def zone_comparison(trips: DataFrame, box=profiles.ZONE_BOX) -> DataFrame:
    zone = F.when(box.contains("pickup_lat", "pickup_lon"), "Manhattan")
    return moving(trips).groupBy(zone_or_other(zone).alias("zone")).agg(
        F.round(stable_avg("speed_mph"), 2).alias("avg_speed"),
        F.round(stable_avg("trip_distance", 4), 2).alias("avg_distance"),
        F.count(F.lit(1)).alias("trip_count"),
    )


def zone_or_other(zone: Column) -> Column:
    return F.coalesce(zone, F.lit("Outer Boroughs"))


def rush_hotspots(
    trips: DataFrame, below: float = 20.0, min_trips: int = 10, k: int | None = None
) -> DataFrame:
    """Cells that are slow in rush hours, slowest first, with rank and severity.

    The ranking window sees one row per cell, whose number the grid bounds (45 x 56).
    """
    order = (F.col("avg_speed"), F.col("cell_id"))
    cells = (
        moving(trips)
        .filter(temporal.is_rush_hour("hour") == 1)
        .groupBy("cell_id")
        .agg(
            F.round(stable_avg("speed_mph"), 2).alias("avg_speed"),
            F.count(F.lit(1)).alias("trip_count"),
        )
        .filter((F.col("avg_speed") < below) & (F.col("trip_count") >= min_trips))
    )
    ranked = (
        top_k(cells, k, *order)
        if k
        else cells.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    )
    return ranked.withColumn("severity", band("avg_speed", profiles.SEVERITY_BANDS))


def band_histogram(df: DataFrame, value: str, bands, name: str = "bucket") -> DataFrame:
    """Rows per band with their share of all rows."""
    counts = df.groupBy(band(value, bands).alias(name)).agg(F.count(F.lit(1)).alias("row_count"))
    total = F.sum("row_count").over(Window.partitionBy())
    return counts.withColumn("percent", percent_of("row_count", total, 2)).orderBy(name)


def speed_histogram(trips: DataFrame, bands=profiles.SPEED_BANDS) -> DataFrame:
    return band_histogram(moving(trips), "speed_mph", bands)


def distance_segments(trips: DataFrame) -> DataFrame:
    return band_histogram(trips, "trip_distance", profiles.DISTANCE_SEGMENTS, "segment")


def weekday_profile(trips: DataFrame) -> DataFrame:
    """Speed profile per weekday (1 = Sunday), by partial aggregation."""
    days = moving(trips).groupBy("day_of_week").agg(
        F.round(stable_avg("speed_mph"), 2).alias("avg_speed"),
        F.round(F.min("speed_mph"), 2).alias("min_speed"),
        F.round(F.max("speed_mph"), 2).alias("max_speed"),
        F.count(F.lit(1)).alias("trip_count"),
    )
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return days.withColumns({
        "day_name": F.element_at(names, F.col("day_of_week")),
        "level": band("avg_speed", profiles.DAY_BANDS),
    }).orderBy("day_of_week")


def keyed_totals(df: DataFrame, key: Column, value: str) -> DataFrame:
    """Sum, count and mean of an integer column per key expression."""
    value = F.col(value)
    return df.groupBy(key.alias("key")).agg(
        F.sum(value).alias("total"), F.count(value).alias("n"), F.avg(value).alias("mean")
    )


def peak_times(trips: DataFrame) -> DataFrame:
    """Busiest hour and weekday with their counts, the earliest one on ties.

    One pass counts the at most 168 pairs of hour and weekday; both answers come from those.
    """
    pairs = trips.groupBy("hour", "day_of_week").agg(F.count(F.lit(1)).alias("n"))
    kinds = pairs.select(
        "n",
        F.explode(F.array(
            F.struct(F.lit("hour").alias("kind"), F.col("hour").alias("position")),
            F.struct(F.lit("weekday").alias("kind"), F.col("day_of_week").alias("position")),
        )).alias("k"),
    )
    return kinds.groupBy("k.kind", "k.position").agg(F.sum("n").alias("n")).groupBy("kind").agg(
        F.max_by("position", F.struct("n", -F.col("position"))).alias("peak"),
        F.max("n").alias("trip_count"),
    )


def speed_classes(trips: DataFrame) -> DataFrame:
    """Trips slower than 10, from 10 to 20 and from 20 mph, with percent of all."""
    speed = F.col("speed_mph")
    wide = trips.agg(
        F.count_if(speed < 10).alias("high"),
        F.count_if((speed >= 10) & (speed < 20)).alias("medium"),
        F.count_if(speed >= 20).alias("low"),
        F.count(speed).alias("total"),
    )
    return wide.select(
        "high", "medium", "low", "total",
        *[percent_of(n, "total").alias(f"{n}_percent") for n in ("high", "medium", "low")],
    )


def width_histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Counts in ``bins`` equal intervals from minimum to maximum; the last one is closed.

    Values are counted once per distinct value; extent and bins come from these counts.
    Values that are no finite numbers are in no bin.
    """
    counted, _ = quantiles.count_values(df, value)
    extent = counted.agg(F.struct(F.min("_v").alias("low"), F.max("_v").alias("high")).alias("e")).scalar()
    low, high = extent.getField("low"), extent.getField("high")
    position = F.floor(F.try_divide((F.col("_v") - low) * float(bins), high - low))
    index = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")
    return counted.groupBy(index.alias("bin")).agg(F.sum("_n").alias("row_count"))


def robust_statistics(df: DataFrame, value: str, valid: Column) -> DataFrame:
    """Count, mean, exact median, deviation, minimum and maximum of the valid, finite values.

    All of it comes from the counts per distinct value, so ``df`` is read once.
    """
    counted, distinct = quantiles.count_values(df.filter(valid), value)
    n, v = F.col("_n"), F.col("_v")
    total = F.sum(n).cast("double")
    mean = F.try_divide(F.sum(fixed_point(v, 6) * n).cast("double"), total * 1e6)
    centre = counted.agg(mean.alias("m")).scalar()
    moments = counted.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("value_count"),
        mean.alias("mean"),
        F.when(F.sum(n) > 1, F.sqrt(F.sum(n * (v - centre) * (v - centre)) / (total - 1))).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )
    found = quantiles.quantiles_of_counts(
        counted, distinct, {"median": 0.5}, (), quantiles.SLOTS, quantiles.LARGEST_SLOT
    )
    return moments.withColumn("median", found.select("median").scalar())


def zone_speed_percentiles(trips: DataFrame, probabilities=(0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    zone = zone_or_other(F.when(F.col("is_manhattan"), "Manhattan"))
    return exact_quantiles(
        moving(trips).withColumn("zone", zone),
        "speed_mph",
        {f"p{int(p * 100)}": p for p in probabilities},
        ("zone",),
    )


def speed_variance(trips: DataFrame) -> DataFrame:
    return trips.groupBy("cell_id").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.coalesce(F.var_samp("speed_mph"), F.lit(0.0)).alias("speed_variance"),
    )


def smallest_rows(df: DataFrame, n: int, order: list[str], coarse: Column) -> DataFrame:
    """First ``n`` rows by ``order``, for an ``n`` too large for one top-k heap per task.

    ``coarse`` is a monotone, coarser version of the order. Counting rows per coarse value
    gives the last coarse value needed, and a filter drops everything beyond it. Copies of
    a row are then counted map-side, so a row repeated millions of times stays one row until
    the end; the final top-k sees distinct rows only and repeats each as often as needed.
    """
    counts = df.groupBy(coarse.alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy("_c").rowsBetween(Window.unboundedPreceding, 0)
    last = (
        counts.withColumn("_upto", F.sum("_n").over(running))
        .filter(F.col("_upto") >= n)
        .agg(F.min("_c"))
        .scalar()
    )
    rest = [c for c in df.columns if c not in order]
    distinct = (
        df.filter(last.isNull() | (coarse <= last))
        .groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .orderBy(*order, *rest)
        .limit(n)
    )
    upto = Window.orderBy(*order, *rest).rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("_copies").over(upto) - F.col("_copies")
    return (
        distinct.withColumn("_take", F.least(F.col("_copies"), F.lit(n) - before))
        .filter(F.col("_take") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_take").cast("int"))))
        .select(*df.columns)
    )


def hash_sample(df: DataFrame, n: int, keys: list[str], buckets: int = 65536) -> DataFrame:
    """Exactly ``n`` rows (or all), the same ones on every run: smallest key hashes first."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    digest = F.md5(text)
    coarse = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets
    ordered = df.withColumns({"_slot": coarse, "_digest": digest})
    return smallest_rows(ordered, n, ["_slot", "_digest"], F.col("_slot")).select(*df.columns)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42, replace: bool = False):
    return df.sample(withReplacement=replace, fraction=fraction, seed=seed)


def with_density(cells: DataFrame, value: str = "trip_count") -> DataFrame:
    """``value`` relative to the largest one of the table, as a scalar subquery."""
    largest = cells.agg(F.max(value)).scalar()
    return cells.withColumn("density_score", F.col(value).cast("double") / largest)


def cell_history(cells: DataFrame) -> DataFrame:
    """Per cell and day: mean index, its peak and low with the hour of each."""
    index = labels.speed_index("avg_speed")
    day = F.date_trunc("day", F.col("hour_bucket"))
    # index and hour packed into one number, so that the rows are aggregated by hash
    packed = lambda hour: ordered_form("index").cast("decimal(38,0)") * 32 + hour
    return (
        cells.select("cell_id", day.alias("day"), "hour", index.alias("index"))
        .groupBy("cell_id", "day")
        .agg(
            stable_avg("index", 6).alias("avg_congestion"),
            F.max("index").alias("peak_congestion"),
            F.max_by("hour", packed(31 - F.col("hour"))).alias("peak_hour"),
            F.min("index").alias("low_congestion"),
            F.min_by("hour", packed(F.col("hour"))).alias("low_hour"),
        )
    )


def history_series(
    trips: DataFrame,
    interval: str = "1 hour",
    hours: int | None = None,
    cell: str | None = None,
    newest: datetime | None = None,
) -> DataFrame:
    """Mean index, vehicles and mean speed per time step, optionally the last ``hours`` only.

    The bound is a literal, so it reaches the scan and the folders of a month. ``newest`` is the
    time to count back from; left out, one pass over the time column finds it.
    """
    if cell is not None:
        trips = trips.filter(F.col("cell_id") == cell)
    if hours is not None:
        newest = newest or trips.agg(F.max("pickup_datetime")).first()[0]
        if newest is not None:
            trips = trips.filter(F.col("pickup_datetime") > F.lit(newest - timedelta(hours=hours)))
    steps = trips.groupBy(F.window("pickup_datetime", interval).alias("w")).agg(
        stable_avg(labels.speed_index("speed_mph"), 6).alias("avg_congestion"),
        F.count(F.lit(1)).alias("total_vehicles"),
        stable_avg("speed_mph").alias("avg_speed"),
    )
    return steps.select(
        F.col("w.start").alias("bucket"), "avg_congestion", "total_vehicles", "avg_speed"
    )


def hourly_trend(cells: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Change of the congestion index against the previous hour of the cell, in percent points."""
    by_cell = Window.partitionBy("cell_id").orderBy("hour_bucket")
    index = labels.speed_index("avg_speed")
    before, at = F.lag("congestion_index").over(by_cell), F.lag("hour_bucket").over(by_cell)
    hour_apart = F.unix_timestamp("hour_bucket") - F.unix_timestamp(at) == 3600
    change = F.when(hour_apart, (F.col("congestion_index") - before) * 100.0)
    trend = (
        F.when(F.col("change_1h") > threshold, "increasing")
        .when(F.col("change_1h") < -threshold, "decreasing")
        .otherwise("stable")
    )
    return (
        cells.withColumn("congestion_index", index)
        .withColumn("change_1h", change)
        .withColumn("trend", trend)
    )


def recent_points(series: DataFrame, n: int, time: str = "bucket") -> DataFrame:
    """The last ``n`` points of a series."""
    return series.orderBy(F.desc(time)).limit(n)
