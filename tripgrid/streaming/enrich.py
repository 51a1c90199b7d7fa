"""Joining live events with the cell history a trained model needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripgrid import profiles
from tripgrid.functions.numeric import fixed_point, stable_avg
from tripgrid.operators.features import with_lags

# stand-in inputs for cells without history
DEFAULT_TRIPS = 10
DEFAULT_SPEED = 15.0
DEFAULT_LABEL = 1

_CELL = ["cell_lat", "cell_lon"]


def history_snapshot(cells: DataFrame) -> DataFrame:
    """One row per cell and hour of the day: historical means and the cell's newest two hours.

    From labelled cell hours. Every cell has all 24 hours, with null means where the hour was
    never seen, so an event at a new hour still finds the lags of its cell. The size is bounded
    by cells x 24; write it as a table and read it back, so the stream joins a static table
    whose file size Spark knows.
    """
    history = cells.groupBy(*_CELL, "hour").agg(
        F.avg("trip_count").alias("historical_avg_trips"),
        stable_avg("avg_speed", 6).alias("historical_avg_speed"),
    )
    newest = with_lags(cells).groupBy(*_CELL).agg(
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
    return newest.select(*_CELL, hours, "n.*").join(history, [*_CELL, "hour"], "left")


def enrich_events(events: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Events with all model inputs.

    Lags and hourly means are defaulted each on its own: a cell without any history gets all
    stand-ins, a known cell at an hour it was never seen in keeps its lags.

    The join carries no broadcast hint. Spark broadcasts the snapshot while its known size
    is under the session's threshold and shuffles by cell and hour beyond it. A stream joined
    this way reads the snapshot once; ``refreshed`` reads it again for each batch.
    """
    return _inputs(events.join(snapshot, [*_CELL, "hour"], "left"))


def _inputs(joined: DataFrame) -> DataFrame:
    """All model inputs of events joined with what is known of their cell."""
    fill = lambda name, value: F.coalesce(F.col(name), F.lit(value)).alias(name)
    passed = ("hour", "day_of_week", "is_weekend", "is_rush_hour", "is_night", *_CELL)
    inputs = {
        **{name: F.col(name) for name in passed},
        "month": F.month("event_ts").alias("month"),
        "is_manhattan_int": F.col("is_manhattan").alias("is_manhattan_int"),
        "prev_trip_count": fill("prev_trip_count", DEFAULT_TRIPS),
        "prev_avg_speed": fill("prev_avg_speed", DEFAULT_SPEED),
        "prev_congestion_label": fill("prev_congestion_label", DEFAULT_LABEL),
        "prev_2h_trip_count": fill("prev_2h_trip_count", 0),
        "prev_2h_avg_speed": fill("prev_2h_avg_speed", 0.0),
        "historical_avg_trips": fill("historical_avg_trips", float(DEFAULT_TRIPS)),
        "historical_avg_speed": fill("historical_avg_speed", DEFAULT_SPEED),
    }
    return joined.select(
        "event_id", "event_ts", "cell_id", "speed",
        *[inputs[name] for name in profiles.FEATURE_COLUMNS],
    )


def history_as_of(cells: DataFrame, moments: DataFrame) -> DataFrame:
    """Lags and hourly means of a cell as they were known at a moment.

    ``cells`` are labelled cell hours; ``moments`` has cell_lat, cell_lon and ``at``, the beginning
    of an hour. Known at a moment are the hours before it. Moments and hours of a cell are sorted
    together once; their number is bounded by the hours covered, whatever the number of events.
    """
    known = with_lags(cells).select(
        *_CELL, F.col("hour_bucket").alias("at"), "hour", F.lit(True).alias("_known"), "trip_count",
        fixed_point("avg_speed", 6).alias("_units"),
        F.struct(
            F.col("trip_count").alias("prev_trip_count"),
            F.col("avg_speed").alias("prev_avg_speed"),
            F.col("congestion_label").alias("prev_congestion_label"),
            F.col("prev_trip_count").alias("prev_2h_trip_count"),
            F.col("prev_avg_speed").alias("prev_2h_avg_speed"),
        ).alias("_row"),
    )
    asked = moments.select(*_CELL, "at", F.hour("at").alias("hour"), F.lit(False).alias("_known"))
    both = known.unionByName(asked, allowMissingColumns=True)
    # an hour is known after the moments at its beginning
    before = lambda *keys: Window.partitionBy(*keys).orderBy("at", "_known").rowsBetween(Window.unboundedPreceding, -1)
    same_hour = before(*_CELL, "hour")
    n = F.count("trip_count").over(same_hour).cast("double")
    filled = both.withColumns({
        "_last": F.last("_row", ignorenulls=True).over(before(*_CELL)),
        "historical_avg_trips": F.try_divide(F.sum("trip_count").over(same_hour).cast("double"), n),
        "historical_avg_speed": F.try_divide(F.sum("_units").over(same_hour).cast("double"), n * 1e6),
    })
    return filled.filter(~F.col("_known")).select(
        *_CELL, "at", "_last.*", "historical_avg_trips", "historical_avg_speed"
    )


def enrich_as_of(events: DataFrame, cells: DataFrame) -> DataFrame:
    """Like ``enrich_events``, with what was known at the beginning of each event's hour.

    So training rows replayed as events see nothing of the future. Each cell and hour is looked
    up once, and events meet the result by an equi-join that adaptive execution can split.
    """
    timed = events.withColumn("at", F.date_trunc("hour", "event_ts"))
    moments = timed.select(*_CELL, "at").distinct()
    return _inputs(timed.join(history_as_of(cells, moments), [*_CELL, "at"], "left"))


def refreshed(path: str, score=lambda enriched: enriched):
    """Function for batches that enriches with the snapshot stored at ``path`` by then."""

    def run(batch: DataFrame) -> DataFrame:
        return score(enrich_events(batch, batch.sparkSession.read.parquet(path)))

    return run
