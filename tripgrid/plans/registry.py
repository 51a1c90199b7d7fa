"""Named queries over a folder of test tables, each with its SQL twin where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is a self-contained statement for another engine."""

    def add(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return add


def rounded(df: DataFrame, digits: int = 4, columns: list[str] | None = None) -> DataFrame:
    """Double columns rounded for comparison with another engine."""
    names = columns or [n for n, t in df.dtypes if t == "double"]
    return df.withColumns({n: F.round(n, digits) for n in names})


def lit_ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")
