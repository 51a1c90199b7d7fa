"""Trip records derived from the generic star-schema tables the tests run on.

``lineitem`` becomes raw trips by integer arithmetic, so another SQL engine can derive the
very same rows. All output columns are narrow projections; nothing shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrid.functions.frames import compute_once
from tripgrid.schemas import DATETIME_FORMAT, RAW_TRIP


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# helper columns first, then the raw columns in file order
_HELPERS = {
    "_day": "cast(date_diff(cast(l_shipdate AS date), DATE'1995-01-02') % 21 AS int)",
    "_sod": "cast((l_orderkey * 37 + l_linenumber * 1009) % 86400 AS int)",
    "_dur": "cast(30 + (l_partkey * 53 + l_orderkey * 17 + l_linenumber * 101) % 3600 AS int)",
}
_PICKUP = """timestampadd(SECOND, _sod,
    cast(make_date(2016, cast(1 + _day div 7 AS int), 1 + _day % 7) AS timestamp))"""
_TRIP = {
    "VendorID": "1 + l_linenumber % 2",
    "tpep_pickup_datetime": "_pickup",
    "tpep_dropoff_datetime": "timestampadd(SECOND, _dur, _pickup)",
    "passenger_count": "1 + l_linenumber % 4",
    "trip_distance": "l_quantity / 5.0D",
    "pickup_longitude": """-74.0350D + ((l_partkey div 7) % 14) * 0.01D
        + (l_orderkey % 89) * 0.0001D""",
    "pickup_latitude": """40.6950D + (l_partkey % 7) * 0.01D + (l_orderkey % 97) * 0.0001D
        + CASE WHEN l_linenumber = 7 AND l_orderkey % 3 = 0 THEN 1.0D ELSE 0.0D END""",
    "RatecodeID": "1",
    "store_and_fwd_flag": "'N'",
    "dropoff_longitude": "-73.98D + (l_partkey % 50) * 0.0001D",
    "dropoff_latitude": "40.75D + (l_suppkey % 50) * 0.0001D",
    "payment_type": "1 + l_linenumber % 4",
    "fare_amount": "l_extendedprice / 1000.0D",
    "extra": "0.0D",
    "mta_tax": "0.0D",
    "tip_amount": "0.0D",
    "tolls_amount": "0.0D",
    "improvement_surcharge": "0.0D",
    "total_amount": "l_extendedprice / 1000.0D * (1.0D + l_tax)",
}


def _named(expressions: dict[str, str]) -> list[str]:
    return [f"{text} AS {name}" for name, text in expressions.items()]


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Typed raw trips, with the order key kept for the faulty variant."""
    timed = lineitem.selectExpr("*", *_named(_HELPERS)).selectExpr("*", f"{_PICKUP} AS _pickup")
    # only the pickup time costs enough to be kept from copying; the rest is pruned at the scan
    return compute_once(timed, ["_pickup"]).selectExpr("l_orderkey", *_named(_TRIP))


def typed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips whose datetimes are timestamps already."""
    return trips_from_lineitem(table(spark, sf_dir, "lineitem")).select(*RAW_TRIP.names)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips as files hold them: datetimes are text."""
    return _as_text(trips_from_lineitem(table(spark, sf_dir, "lineitem"))).select(*RAW_TRIP.names)


def faulty_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips with unparsable dates, missing counts, zero durations and odd name case."""
    c = F.col
    trips = trips_from_lineitem(table(spark, sf_dir, "lineitem")).withColumn(
        "tpep_dropoff_datetime",
        F.when(c("l_orderkey") % 307 == 0, c("tpep_pickup_datetime"))
        .otherwise(c("tpep_dropoff_datetime")),
    )
    trips = _as_text(trips).withColumns({
        "tpep_pickup_datetime": F.when(c("l_orderkey") % 211 == 0, "not-a-date")
        .otherwise(c("tpep_pickup_datetime")),
        "passenger_count": F.when(c("l_orderkey") % 53 != 0, c("passenger_count")),
    })
    return trips.select(*[c(n).alias(n.upper()) for n in RAW_TRIP.names])


def _as_text(trips: DataFrame) -> DataFrame:
    names = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
    return trips.withColumns({n: F.date_format(n, DATETIME_FORMAT) for n in names})


def generic_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as speed readings keyed by event type."""
    return with_speed(table(spark, sf_dir, "events"))


def with_speed(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.col("event_type").alias("cell_id"),
        F.least(F.lit(60.0), F.greatest(F.lit(1.0), F.col("value"))).alias("speed"),
    )
