"""Current traffic state: one row per cell, and the questions asked of it.

The state is bounded by the number of grid cells. ``traffic_state`` builds it from the
feature table with one partial aggregation; every other function here is a projection,
filter or top-k on that small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrid import profiles
from tripgrid.functions import grid, labels, temporal
from tripgrid.functions.numeric import stable_avg
from tripgrid.operators.analysis import top_k
from tripgrid.operators.joins import join_predictions

STATE_COLUMNS = (
    "cell_id", "latitude", "longitude", "congestion_index", "congestion_level",
    "vehicle_count", "avg_speed", "hour", "is_manhattan", "last_update", "source",
)


def traffic_state(features: DataFrame, source: str = "batch") -> DataFrame:
    """State from the feature table: historical speed, typical trips and position per cell."""
    cells = features.groupBy("cell_lat", "cell_lon").agg(
        stable_avg("historical_avg_speed", 6).alias("speed"),
        F.avg("prev_trip_count").alias("trips"),
        F.avg("hour").alias("mean_hour"),
        F.max("is_manhattan_int").alias("zone"),
        F.max("hour_bucket").alias("last_update"),
    )
    lat, lon = grid.centre_coordinates("cell_lat", "cell_lon", profiles.STATE_CENTRES)
    return cells.select(
        grid.cell_id("cell_lat", "cell_lon").alias("cell_id"),
        F.round(lat, 6).alias("latitude"),
        F.round(lon, 6).alias("longitude"),
        F.round(labels.piecewise_index("speed"), 3).alias("congestion_index"),
        labels.piecewise_level("speed").alias("congestion_level"),
        F.greatest(F.lit(1), F.col("trips").cast("int")).cast("long").alias("vehicle_count"),
        F.round("speed", 1).alias("avg_speed"),
        F.col("mean_hour").cast("int").alias("hour"),
        (F.col("zone") == 1).alias("is_manhattan"),
        "last_update",
        F.lit(source).alias("source"),
    )


def current_traffic(
    state: DataFrame, min_index: float = 0.0, limit: int | None = None
) -> DataFrame:
    """Cells from the most congested down; all of them unless ``limit`` is given."""
    ordered = state.filter(F.col("congestion_index") >= min_index).orderBy(
        F.desc("congestion_index"), "cell_id"
    )
    return ordered if limit is None else ordered.limit(limit)


def hotspots(state: DataFrame, k: int = 10) -> DataFrame:
    return top_k(state, k, F.desc("congestion_index"), F.col("cell_id"))


def overview(state: DataFrame) -> DataFrame:
    """Cells, vehicles, mean index and speed, and the number of cells per level."""
    level = lambda name: F.count_if(F.col("congestion_level") == name)
    return state.agg(
        F.count(F.lit(1)).alias("total_cells"),
        F.sum("vehicle_count").alias("total_vehicles"),
        F.round(stable_avg("congestion_index", 3), 3).alias("avg_congestion"),
        F.round(stable_avg("avg_speed", 1), 1).alias("avg_speed"),
        level("low").alias("low"),
        level("medium").alias("medium"),
        level("high").alias("high"),
    )


def source_breakdown(state: DataFrame, live: str = "live") -> DataFrame:
    is_live = F.coalesce(F.col("source") == live, F.lit(False))
    return state.agg(
        F.count_if(is_live).alias("live_cells"),
        F.count_if(~is_live).alias("batch_cells"),
        F.count(F.lit(1)).alias("total"),
    )


def newest_source(states: DataFrame, live: str = "live") -> DataFrame:
    """Per cell the source of its newest record; of equal times the live one.

    Time and source are packed into one number, so the records are aggregated by hash.
    """
    is_live = F.coalesce(F.col("source") == live, F.lit(False)).cast("long")
    newest = states.groupBy("cell_id").agg(F.max(F.unix_micros("last_update") * 2 + is_live).alias("packed"))
    return newest.select("cell_id", F.when(F.col("packed") % 2 == 1, live).otherwise("batch").alias("source"))


def overview_series(cells: DataFrame) -> DataFrame:
    """The overview metrics per hour, from labelled cell hours."""
    index = labels.piecewise_index("avg_speed")
    return cells.groupBy(F.col("hour_bucket").alias("bucket")).agg(
        F.count(F.lit(1)).alias("total_cells"),
        F.sum("trip_count").alias("total_vehicles"),
        stable_avg(index, 6).alias("avg_congestion"),
        stable_avg("avg_speed", 6).alias("avg_speed"),
    )


def scoring_rows(state: DataFrame, as_of: Column) -> DataFrame:
    """Model inputs of each cell at the moment ``as_of``.

    The state has no history, so the current values stand in for the lags, and the two-hour
    lags are the current values scaled by 0.9 and 1.1. Weekdays are numbered 1 = Sunday, as in
    the training data.
    """
    lat_index, lon_index = grid.parse_cell_id("cell_id")
    vehicles, speed = F.col("vehicle_count"), F.col("avg_speed")
    hour, day = F.hour(as_of), F.dayofweek(as_of)
    return state.select(
        "cell_id",
        hour.alias("hour"),
        day.alias("day_of_week"),
        F.month(as_of).alias("month"),
        temporal.is_weekend(day).alias("is_weekend"),
        temporal.is_rush_hour(hour).alias("is_rush_hour"),
        temporal.is_night(hour).alias("is_night"),
        F.coalesce(lat_index, F.lit(0)).alias("cell_lat"),
        F.coalesce(lon_index, F.lit(0)).alias("cell_lon"),
        F.col("is_manhattan").cast("int").alias("is_manhattan_int"),
        vehicles.alias("prev_trip_count"),
        speed.alias("prev_avg_speed"),
        labels.level_code("congestion_level").alias("prev_congestion_label"),
        (vehicles * F.lit(0.9)).alias("prev_2h_trip_count"),
        (speed * F.lit(1.1)).alias("prev_2h_avg_speed"),
        vehicles.cast("double").alias("historical_avg_trips"),
        speed.alias("historical_avg_speed"),
    )


def rule_predictions(rows: DataFrame) -> DataFrame:
    """Scores of the state rule: cell_id, prediction, predicted_level, confidence, model."""
    rule = labels.state_rule("prev_avg_speed", "is_rush_hour", "is_manhattan_int")
    return rows.select("cell_id", rule.alias("r")).select(
        "cell_id",
        F.col("r.prediction").alias("prediction"),
        F.lower(labels.level_name("r.prediction")).alias("predicted_level"),
        F.col("r.confidence").alias("confidence"),
        F.lit("rule-based").alias("model_used"),
    )


def prediction_report(
    state: DataFrame, predictions: DataFrame, min_confidence: float = 0.7
) -> DataFrame:
    """Current against predicted congestion of every cell predicted confidently enough."""
    predicted = F.col("prediction") / 2.0
    joined = join_predictions(
        state.select(
            "cell_id", "latitude", "longitude",
            F.col("congestion_level").alias("current_level"),
            F.col("congestion_index").alias("_index"),
        ),
        predictions.filter(F.col("confidence") >= min_confidence),
    )
    return joined.select(
        "cell_id", "latitude", "longitude", "current_level",
        F.round("_index", 3).alias("current_index"),
        "predicted_level",
        F.round(predicted, 3).alias("predicted_index"),
        "confidence",
        F.round((predicted - F.col("_index")) * 100.0, 1).alias("change_percent"),
        "model_used",
    ).orderBy(F.desc("predicted_index"), "cell_id")


def cell_details(state: DataFrame, cell: str, as_of: Column) -> DataFrame:
    """State and rule prediction of one cell; no row when the cell is unknown."""
    one = state.filter(F.col("cell_id") == cell)
    scored = one.withColumn(
        "r",
        labels.state_rule(
            "avg_speed", temporal.is_rush_hour(F.hour(as_of)), F.col("is_manhattan").cast("int")
        ),
    )
    return scored.select(
        "cell_id", "latitude", "longitude", "congestion_index", "congestion_level",
        "vehicle_count", "avg_speed",
        F.lower(labels.level_name("r.prediction")).alias("predicted_level"),
        F.round(F.col("r.prediction") / 2.0, 3).alias("predicted_index"),
        F.col("r.confidence").alias("confidence"),
        "last_update",
    )


def bridge_state(windows: DataFrame) -> DataFrame:
    """State records from window aggregates, with defaults for missing fields."""
    default = lambda name, value: F.coalesce(F.col(name), F.lit(value))
    lat, lon = grid.centre_coordinates(
        default("cell_lat", 0), default("cell_lon", 0), profiles.BRIDGE_CENTRES
    )
    level = default("congestion_level", "Medium")
    return windows.filter(F.col("cell_id").isNotNull()).select(
        "cell_id",
        F.round(lat, 6).alias("latitude"),
        F.round(lon, 6).alias("longitude"),
        labels.level_to_index(level).alias("congestion_index"),
        F.lower(level).alias("congestion_level"),
        default("trip_count", 0).cast("long").alias("vehicle_count"),
        F.round(default("avg_speed", 20.0), 1).alias("avg_speed"),
        F.round(default("max_speed", 30.0), 1).alias("max_speed"),
        F.round(default("min_speed", 5.0), 1).alias("min_speed"),
        F.col("window_end").alias("last_update"),
        F.lit("stream").alias("source"),
    )


def latest_per_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The row that is largest by ``order`` per key, as a partial aggregate.

    The whole row breaks ties, so the choice does not depend on arrival order.
    """
    rest = [c for c in df.columns if c not in (key, *order)]
    row = F.struct(*order, *rest)
    newest = df.groupBy(key).agg(F.max(row).alias("r"))
    return newest.select(key, *[F.col(f"r.{c}").alias(c) for c in df.columns if c != key])


def geojson_features(state: DataFrame, half_size: float = 0.0025) -> DataFrame:
    """One polygon feature per cell: ring, properties and the JSON text of the feature."""
    lat, lon, s = F.col("latitude"), F.col("longitude"), F.lit(half_size)
    ring = F.array(
        F.array(lon - s, lat - s), F.array(lon + s, lat - s), F.array(lon + s, lat + s),
        F.array(lon - s, lat + s), F.array(lon - s, lat - s),
    )
    properties = (
        "cell_id", "congestion_index", "congestion_level", "vehicle_count", "avg_speed", "height"
    )
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Polygon").alias("type"), F.array("ring").alias("coordinates"))
        .alias("geometry"),
        F.struct(*properties).alias("properties"),
    )
    rings = state.withColumns({
        "ring": ring, "height": (F.col("congestion_index") * 1000).cast("int")
    })
    return rings.select(*properties, "ring", F.to_json(feature).alias("feature"))
