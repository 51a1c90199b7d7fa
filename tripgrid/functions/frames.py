"""Frame helpers that shape the plan rather than the result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """``df`` with the named columns evaluated once per row.

    The optimizer pushes a filter below the projection its columns come from by copying
    their expressions into every predicate. A timestamp parsed for four predicates is then
    parsed up to ten times per row, and the generated method may outgrow what the JIT
    compiles. Passing the columns through a one-row generator stops that copying for
    them alone: predicates on the other columns still reach the scan.
    """
    names = names or df.columns
    kept = [c for c in df.columns if c not in names]
    return df.select(*kept, F.inline(F.array(F.struct(*names)))).select(*df.columns)
