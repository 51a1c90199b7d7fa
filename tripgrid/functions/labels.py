"""Congestion labels, indexes and rules as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripgrid import profiles
from tripgrid.functions.numeric import as_col, clamp
from tripgrid.profiles import LabelRule


def congestion_label(speed, rule: LabelRule = profiles.LABELS) -> Column:
    """0 low, 1 medium, 2 high congestion from a mean speed."""
    speed = as_col(speed)
    first, second = rule.cuts
    low = speed >= first if rule.first_inclusive else speed > first
    medium = speed >= second if rule.second_inclusive else speed > second
    return F.when(low, 0).when(medium, 1).otherwise(2)


def level_name(label, rule: LabelRule = profiles.LABELS) -> Column:
    label = as_col(label)
    low, medium, high = rule.names
    return F.when(label == 0, low).when(label == 1, medium).otherwise(high)


def level_code(level) -> Column:
    level = F.lower(as_col(level))
    return F.when(level == "low", 0).when(level == "medium", 1).otherwise(2)


def speed_index(speed, top_speed: float = 50.0) -> Column:
    """Linear index: 1 at standstill, 0 at ``top_speed`` and above."""
    return F.lit(1.0) - clamp(speed, 0.0, top_speed) / top_speed


def piecewise_index(speed, limits=profiles.INDEX_CLAMP_BATCH) -> Column:
    """Index falling in three linear pieces with a kink at 10 and 20 mph, clamped."""
    speed = as_col(speed)
    raw = (
        F.when(speed > 20.0, F.lit(0.3) - (speed - 20.0) * 0.01)
        .when(speed > 10.0, F.lit(0.7) - (speed - 10.0) * 0.04)
        .otherwise(F.lit(1.0) - speed * 0.03)
    )
    return clamp(raw, *limits)


def piecewise_level(speed) -> Column:
    return level_name(congestion_label(speed, profiles.LABELS_LEGACY), profiles.LABELS_LEGACY)


def window_level(speed) -> Column:
    return level_name(congestion_label(speed, profiles.LABELS_WINDOW))


def event_level(speed, rush="is_rush_hour", zone="is_manhattan") -> Column:
    """Level of one event: rush hour inside the zone, else rush hour or slow, else low."""
    rush, zone = as_col(rush) == 1, as_col(zone) == 1
    return (
        F.when(rush & zone, "High")
        .when(rush | (as_col(speed) < 10.0), "Medium")
        .otherwise("Low")
    )


def state_rule(speed, rush, zone) -> Column:
    """Struct(prediction, confidence) of the rule used where no model is loaded."""
    speed = as_col(speed)
    busy = (as_col(rush) == 1) & (as_col(zone) == 1)
    outcome = lambda p, c: F.struct(F.lit(p).alias("prediction"), F.lit(c).alias("confidence"))
    return (
        F.when((speed < 10.0) | ((speed < 15.0) & busy), outcome(2, 0.82))
        .when(speed < 20.0, outcome(1, 0.75))
        .otherwise(outcome(0, 0.80))
    )


def speed_rule(speed) -> Column:
    """Struct(prediction, confidence) of the rule that looks at the speed alone."""
    speed = as_col(speed)
    outcome = lambda p, c: F.struct(F.lit(p).alias("prediction"), F.lit(c).alias("confidence"))
    return (
        F.when(speed > 20.0, outcome(0, 0.80))
        .when(speed >= 10.0, outcome(1, 0.75))
        .otherwise(outcome(2, 0.85))
    )


def level_to_index(level) -> Column:
    level = F.lower(as_col(level))
    return F.when(level == "low", 0.30).when(level == "high", 0.85).otherwise(0.55)


def index_to_level(index) -> Column:
    index = as_col(index)
    return F.when(index > 0.7, "high").when(index > 0.4, "medium").otherwise("low")
