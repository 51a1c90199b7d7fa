"""All registered queries. Importing the query modules fills the registry."""

from __future__ import annotations

from tripgrid.plans import (
    aggregate_queries,
    cleaning_queries,
    io_queries,
    ml_queries,
    quality_queries,
    state_queries,
    streaming_queries,
)
from tripgrid.plans.registry import ORACLES, QUERIES, Query


MODULES = (
    aggregate_queries, cleaning_queries, io_queries, ml_queries, quality_queries,
    state_queries, streaming_queries,
)


def queries() -> dict[str, Query]:
    return dict(sorted(QUERIES.items()))


def oracle_sql() -> dict[str, str]:
    return dict(sorted(ORACLES.items()))
