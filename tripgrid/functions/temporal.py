"""Calendar and time-of-day expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripgrid import profiles
from tripgrid.functions.numeric import as_col

# weekday numbering -> (expression builder, weekend numbers)
_WEEKDAYS = {
    "sunday1": (F.dayofweek, (1, 7)),
    "monday0": (F.weekday, (5, 6)),
    "monday1": (lambda ts: F.weekday(ts) + 1, (6, 7)),
}


def day_number(ts, weekday: str = "sunday1") -> Column:
    return _WEEKDAYS[weekday][0](as_col(ts))


def is_weekend(day, weekday: str = "sunday1") -> Column:
    """0/1 flag on a day number in the given numbering."""
    return F.when(as_col(day).isin(*_WEEKDAYS[weekday][1]), 1).otherwise(0)


def is_rush_hour(hour) -> Column:
    hour = as_col(hour)
    (a, b), (c, d) = profiles.RUSH_HOURS
    return F.when(hour.between(a, b) | hour.between(c, d), 1).otherwise(0)


def is_night(hour, end_hour: int = profiles.NIGHT_END_MODEL) -> Column:
    hour = as_col(hour)
    return F.when((hour >= profiles.NIGHT_START) | (hour <= end_hour), 1).otherwise(0)


def dataset_split(month) -> Column:
    """Temporal split by calendar month, whatever the year."""
    month = as_col(month)
    return (
        F.when(month.isin(*profiles.TRAIN_MONTHS), "train")
        .when(month.isin(*profiles.TEST_MONTHS), "test")
        .otherwise("other")
    )


def hour_bucket(ts) -> Column:
    return F.date_trunc("hour", as_col(ts))


def iso_text(ts, zulu: bool = False) -> Column:
    suffix = "'Z'" if zulu else ""
    return F.date_format(as_col(ts), "yyyy-MM-dd'T'HH:mm:ss" + suffix)


def from_iso_text(text) -> Column:
    """Timestamp from ISO text with or without zone; null when the text is no timestamp."""
    return F.try_to_timestamp(as_col(text))
