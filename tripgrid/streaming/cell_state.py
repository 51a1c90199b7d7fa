"""Current state per cell inside the stream: keyed state with timers or a time to live.

A cell's state is one row: the running sums of its newest window. An event of a later window
replaces it, one of the same window is added, an earlier one changes nothing, so the result does
not depend on the order of arrival. The state lives in the query's own store and outlives a
restart with its checkpoint; ``read_cell_state`` reads it from there, so no batch writes a folder.

Events are summed up in the task that reads them, before they are dealt by cell. As only the newest
window of a cell counts, a task passes on one row per cell, however many events and windows it reads.
The same sums can be kept in a log of folders (``newest_sums``) instead of a store.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tripgrid.functions import labels
from tripgrid.functions.numeric import fixed_point
from tripgrid.operators.state import latest_per_key
from tripgrid.streaming.windows import LATENESS

PARTIAL = (
    "cell_id string, cell_lat int, cell_lon int, window_end timestamp, trip_count bigint, "
    "speed_units bigint, max_speed double, min_speed double"
)
#: what a cell holds: its newest window
HELD = PARTIAL.removeprefix("cell_id string, ")
#: a row of the stream: the new state, or the last one of a cell that fell silent
CHANGES = f"{PARTIAL}, expired boolean"
STATE = "newest"
UNITS = 100.0
_KEYS = ["cell_id", "cell_lat", "cell_lon", "window_end"]
_SUMS = [("trip_count", "sum"), ("speed_units", "sum"), ("max_speed", "max"), ("min_speed", "min")]
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _newest_sums(table: pa.Table) -> pa.Table:
    """Sums of the newest window of each cell."""
    newest = table.group_by("cell_id").aggregate([("window_end", "max")])
    rows = table.join(newest, ["cell_id", "window_end"], ["cell_id", "window_end_max"], join_type="left semi", use_threads=False)
    grouped = rows.group_by(_KEYS).aggregate(_SUMS)
    return pa.table([grouped[n] for n in (*_KEYS, *[f"{n}_{how}" for n, how in _SUMS])], names=table.column_names).cast(table.schema)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        read = pa.Table.from_batches([batch])
        held = _newest_sums(read if held is None else pa.concat_tables([held, read]))
    if held is not None:
        yield from held.to_batches()


def partial_windows(events: DataFrame, size: str = "1 minute") -> DataFrame:
    """Sums of the newest window per cell among what a task reads."""
    rows = events.select(
        "cell_id", F.col("cell_lat").cast("int"), F.col("cell_lon").cast("int"),
        F.window("event_ts", size)["end"].alias("window_end"),
        F.lit(1).cast("long").alias("trip_count"), fixed_point("speed", 2).alias("speed_units"),
        F.col("speed").alias("max_speed"), F.col("speed").alias("min_speed"),
    )
    return rows.filter("cell_id is not null and window_end is not null").mapInArrow(_summed, PARTIAL)


def newest_sums(rows: DataFrame) -> DataFrame:
    """Merge of a state log over ``partial_windows``: the newest window per cell, its sums added up."""
    sums = rows.groupBy(*_KEYS).agg(*[{"sum": F.sum, "max": F.max, "min": F.min}[how](n).alias(n) for n, how in _SUMS])
    return latest_per_key(sums, "cell_id", "window_end", "cell_lat", "cell_lon")


class NewestWindow(StatefulProcessor):
    """Keeps the newest window of a cell.

    With ``idle_seconds`` a cell that got no newer window for that long is reported as expired and
    forgotten: by a timer on processing time that each change sets anew. ``ttl_seconds`` lets the
    store forget it without a report.
    """

    def __init__(self, idle_seconds: float | None = None, ttl_seconds: float | None = None) -> None:
        self.idle, self.ttl = idle_seconds, ttl_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        ttl = None if self.ttl is None else int(self.ttl * 1000)
        self.newest = handle.getValueState(STATE, HELD, ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = tuple(self.newest.get()) if self.newest.exists() else None
        before = held
        for frame in rows:
            for row in frame.itertuples(index=False):
                held = _later(held, (int(row.cell_lat), int(row.cell_lon), row.window_end.to_pydatetime(),
                                     int(row.trip_count), int(row.speed_units), float(row.max_speed), float(row.min_speed)))
        if held != before:
            self.newest.update(held)
            if self.idle is not None:
                for old in self.handle.listTimers():
                    self.handle.deleteTimer(old)
                self.handle.registerTimer(int(timerValues.getCurrentProcessingTimeInMs() + self.idle * 1000))
            yield self._row(key, held, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.newest.exists():
            held = tuple(self.newest.get())
            self.newest.clear()
            yield self._row(key, held, True)

    def close(self) -> None:
        pass

    @staticmethod
    def _row(key, held: tuple, expired: bool) -> pd.DataFrame:
        names = [c.split()[0] for c in CHANGES.split(", ")]
        return pd.DataFrame([(key[0], *held, expired)], columns=names)


def _later(held: tuple | None, new: tuple) -> tuple:
    """State after one more partial window; of equal windows in two places the larger place counts."""
    if held is None or (new[2], new[0], new[1]) > (held[2], held[0], held[1]):
        return new
    if new[:3] != held[:3]:
        return held
    return (*held[:3], held[3] + new[3], held[4] + new[4], max(held[5], new[5]), min(held[6], new[6]))


def cell_state_stream(
    events: DataFrame, size: str = "1 minute", idle_seconds: float | None = None, ttl_seconds: float | None = None
) -> DataFrame:
    """Stream of state changes per cell; start it within ``keyed_state`` and in update mode."""
    return partial_windows(events, size).groupBy("cell_id").transformWithStateInPandas(
        statefulProcessor=NewestWindow(idle_seconds, ttl_seconds),
        outputStructType=CHANGES, outputMode="Update",
        timeMode="None" if idle_seconds is None and ttl_seconds is None else "ProcessingTime",
    )


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which keyed state needs."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def as_windows(state: DataFrame, size: str = "1 minute") -> DataFrame:
    """State or changes as window aggregates, as ``windows.window_aggregates`` gives them."""
    mean = F.col("speed_units").cast("double") / (F.col("trip_count").cast("double") * UNITS)
    rows = state.withColumn("avg_speed", mean)
    return rows.select(
        "cell_id", "cell_lat", "cell_lon", "trip_count", "avg_speed", "max_speed", "min_speed",
        labels.window_level("avg_speed").alias("congestion_level"),
        (F.col("window_end") - F.expr(f"INTERVAL {size}")).alias("window_start"), "window_end",
    )


def read_cell_state(spark: SparkSession, checkpoint: str, size: str = "1 minute") -> DataFrame:
    """Newest window per cell as the checkpoint of a stopped or running query holds it."""
    stored = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    return as_windows(stored.select("key.cell_id", "value.*"), size)
