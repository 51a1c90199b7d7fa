"""Windows that keep count of the rows their watermark shuts out, and the rows themselves.

A stateful aggregation drops late rows without a trace. Here a batch is split by the watermark of
the batches before it: rows of open windows are summed up and appended to a log of partial sums,
rows of closed ones go to a log of their own. Both logs know the batches they hold, and the
watermark is part of the manifest that adds a batch, so a replay changes nothing and every input
row is in exactly one of the two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrid.functions import labels
from tripgrid.functions.numeric import fixed_point
from tripgrid.streaming.state_log import SEQ, StateLog, all_rows

_SUMS = ("trip_count", "speed_units")


def _added(keys: list[str]) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: rows.drop(SEQ).groupBy(*keys, "window_end").agg(
        *[F.sum(c).alias(c) for c in _SUMS], F.max("max_speed").alias("max_speed"), F.min("min_speed").alias("min_speed")
    )


class LateKeepingWindows:
    """Tumbling windows over batches of events (event_ts, speed and ``keys``), below ``path``."""

    def __init__(
        self, spark: SparkSession, path: str, keys: tuple[str, ...], size: str = "1 minute", lateness_seconds: int = 120, every: int = 16
    ) -> None:
        self.keys, self.size, self.lateness = list(keys), size, lateness_seconds
        self.open = StateLog(spark, f"{path}/windows", _added(self.keys), every)
        self.late = StateLog(spark, f"{path}/late", all_rows(), every)

    def watermark(self) -> int | None:
        """Microseconds since 1970 up to which windows are closed."""
        newest = self.open.current()[1].get("newest")
        return None if newest is None else newest - self.lateness * 1_000_000

    def handle(self, run: str) -> Callable[[DataFrame, int], None]:
        def add(batch: DataFrame, epoch: int) -> None:
            if self.open.current()[1]["done"].get(run, -1) >= epoch:
                return
            seen = batch.filter(F.col("event_ts").isNotNull()).withColumn("window_end", F.window("event_ts", self.size)["end"])
            mark = self.watermark()
            closed = F.lit(False) if mark is None else F.unix_micros("window_end") <= mark
            newest = seen.agg(F.max(F.unix_micros("event_ts"))).first()[0]
            # the late rows first: where the job ends in between, the replay skips them and adds the rest
            self.late.append(seen.filter(closed), run, epoch)
            sums = seen.filter(~closed).select(
                *self.keys, "window_end", F.lit(1).cast("long").alias("trip_count"), fixed_point("speed", 2).alias("speed_units"),
                F.col("speed").alias("max_speed"), F.col("speed").alias("min_speed"),
            )
            self.open.append(sums, run, epoch, {} if newest is None else {"newest": newest})

        return add

    def windows(self, closed_only: bool = True) -> DataFrame:
        """Window aggregates; ``closed_only`` gives those that no row can change any more."""
        rows = self.open.read()
        mark = self.watermark()
        if closed_only and mark is not None:
            rows = rows.filter(F.unix_micros("window_end") <= mark)
        mean = F.col("speed_units").cast("double") / (F.col("trip_count").cast("double") * 100.0)
        level: Column = labels.window_level("avg_speed")
        return rows.withColumn("avg_speed", mean).select(
            *self.keys, "trip_count", "avg_speed", "max_speed", "min_speed", level.alias("congestion_level"), "window_end"
        )

    def late_rows(self) -> DataFrame:
        return self.late.read()
