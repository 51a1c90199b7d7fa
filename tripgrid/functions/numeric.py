"""Numeric expressions whose result does not depend on how rows were partitioned.

A floating-point sum changes with the order of its terms, so a retried task or another
partition count can move a mean across a label threshold. The means here add fixed-point
longs instead; integer addition is associative and the partial sums combine map-side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def fixed_point(value, digits: int) -> Column:
    """``value`` as a long counting units of ``10**-digits``, half rounded up."""
    return F.floor(as_col(value) * float(10**digits) + 0.5)


def _finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value.cast("double")) < float("inf"))


def _mean(value: Column, digits: int, over) -> Column:
    """Mean from fixed-point sums; NaN and infinities give what ``avg`` gives."""
    total = over(F.sum(F.when(_finite(value), fixed_point(value, digits)).otherwise(0)))
    odd = over(F.sum(F.when(~_finite(value), value.cast("double"))))
    n = over(F.count(value))
    return F.coalesce(odd, F.try_divide(total.cast("double"), n.cast("double") * float(10**digits)))


def stable_avg(value, digits: int = 2) -> Column:
    """Mean of a column holding at most ``digits`` decimals, correctly rounded.

    More decimals are rounded to ``digits`` row by row first. A long overflows at 9.2e18 units:
    1.5e15 rows of 60.00 with two digits. NaN and infinities pass through as in ``avg``.
    """
    return _mean(as_col(value), digits, lambda c: c)


def stable_avg_over(value, window, digits: int = 6) -> Column:
    """``stable_avg`` as a window function."""
    return _mean(as_col(value), digits, lambda c: c.over(window))


def clamp(value, low: float | None = None, high: float | None = None) -> Column:
    value = as_col(value)
    if high is not None:
        value = F.least(value, F.lit(high))
    if low is not None:
        value = F.greatest(value, F.lit(low))
    return value


def band(value, bands) -> Column:
    """First name in ``bands`` whose upper bound exceeds ``value``; the last bound is None."""
    value = as_col(value)
    (bound, name), rest = bands[0], bands[1:]
    chain = F.when(value < bound, name)
    for bound, name in rest:
        chain = chain.when(value < bound, name) if bound is not None else chain.otherwise(name)
    return chain


def percent_of(part, whole, digits: int = 1) -> Column:
    return F.round(F.try_divide(as_col(part) * 100.0, as_col(whole)), digits)
