"""Data quality and profiling reports, each one pass over the input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgrid import profiles
from tripgrid.functions.numeric import percent_of, stable_avg
from tripgrid.operators.cleaning import cleaning_rules, prepare_trips

COORDINATE_DIGITS = 6


def _passes(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def _cumulative(rules: dict[str, Column]) -> dict[str, Column]:
    tests = [_passes(t) for t in rules.values()]
    return {name: reduce(Column.__and__, tests[: i + 1]) for i, name in enumerate(rules)}


def row_funnel(df: DataFrame, profile=profiles.STANDARD) -> DataFrame:
    """Rows left after each rule, as (step, rule, rows). One scan instead of one per rule."""
    df = prepare_trips(df, profile)
    kept = _cumulative(cleaning_rules(df, profile))
    counts = df.agg(
        F.count(F.lit(1)).alias("raw"), *[F.count_if(t).alias(n) for n, t in kept.items()]
    )
    names = ["raw", *kept]
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(n).alias("rule"), F.col(n).alias("rows"))
        for i, n in enumerate(names)
    ])).alias("r")).select("r.*")


def observed_funnel(df: DataFrame, profile=profiles.STANDARD) -> tuple[DataFrame, Observation]:
    """``df`` prepared for cleaning, and an observation of the funnel's counts.

    The counts are complete once any action has read the frame to its end, so a job that writes
    the clean rows gets its funnel from the same pass.
    """
    prepared = prepare_trips(df, profile)
    kept = _cumulative(cleaning_rules(prepared, profile))
    counts = {"raw": F.count(F.lit(1)), **{n: F.count_if(t) for n, t in kept.items()}}
    seen = Observation()
    return prepared.observe(seen, *[c.alias(n) for n, c in counts.items()]), seen


def funnel_table(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    rows = [(i, n, c) for i, (n, c) in enumerate(counts.items())]
    return spark.createDataFrame(rows, "step int, rule string, rows bigint")


def removal_report(df: DataFrame, profile=profiles.COMPACT, source: Column | None = None):
    """Rows each rule removes and the share kept, per source (default: pickup month)."""
    df = prepare_trips(df, profile)
    rules = cleaning_rules(df, profile)
    kept = _cumulative(rules)
    if source is None:
        source = F.date_format("pickup_datetime", "yyyy-MM")
    names = list(rules)
    report = df.groupBy(F.coalesce(source, F.lit("unknown")).alias("source")).agg(
        F.count(F.lit(1)).alias("initial"), *[F.count_if(kept[n]).alias(n) for n in names]
    )
    previous = ["initial", *names[:-1]]
    return report.select(
        "source",
        "initial",
        *[(F.col(p) - F.col(n)).alias(f"{n}_removed") for p, n in zip(previous, names)],
        F.col(names[-1]).alias("final"),
        percent_of(names[-1], "initial").alias("retention_percent"),
    )


def _long_form(wide: DataFrame, rows: list[list[tuple[str, Column]]]) -> DataFrame:
    """One wide row of aggregates as one row per struct in ``rows``."""
    structs = [F.struct(*[value.alias(name) for name, value in row]) for row in rows]
    return wide.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def missing_report(df: DataFrame) -> DataFrame:
    """Missing count and percent of every column, worst first."""
    quoted = {n: F.col(f"`{n}`") for n in df.columns}
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(c.isNull()).alias(f"_m{i}") for i, c in enumerate(quoted.values())],
    )
    long = _long_form(wide, [
        [("column_name", F.lit(n)), ("missing_count", F.col(f"_m{i}")), ("_n", F.col("_rows"))]
        for i, n in enumerate(quoted)
    ])
    return long.select(
        "column_name", "missing_count", percent_of("missing_count", "_n", 2).alias("missing_percent")
    ).orderBy(F.desc("missing_count"), "column_name")


def coordinate_report(df: DataFrame) -> DataFrame:
    """Minimum, maximum and mean of each numeric column with ``lat`` or ``lon`` in its name."""
    names = [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType)
        and any(part in f.name.lower() for part in ("lat", "lon"))
    ]
    aggs = []
    for n in names:
        aggs += [
            F.min(n).alias(f"{n}__min"),
            F.max(n).alias(f"{n}__max"),
            stable_avg(n, COORDINATE_DIGITS).alias(f"{n}__mean"),
        ]
    return _long_form(df.agg(*aggs), [
        [
            ("column_name", F.lit(n)),
            ("min_value", F.col(f"{n}__min").cast("double")),
            ("max_value", F.col(f"{n}__max").cast("double")),
            ("mean_value", F.col(f"{n}__mean")),
        ]
        for n in names
    ])


def coordinate_validity(df: DataFrame, lat: str, lon: str, box=profiles.CITY_BOX) -> DataFrame:
    valid = F.count_if(box.contains(lat, lon))
    total = F.count(F.lit(1))
    return df.agg(total.alias("total"), valid.alias("valid")).select(
        "total",
        "valid",
        (F.col("total") - F.col("valid")).alias("invalid"),
        percent_of("valid", "total").alias("valid_percent"),
    )


def file_report(df: DataFrame) -> DataFrame:
    """Rows and bytes of every input file; ``df`` must come straight from a file scan."""
    return df.groupBy(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("size_bytes"),
    ).agg(F.count(F.lit(1)).alias("records"))


def with_total(report: DataFrame) -> DataFrame:
    """A file report with one more row named ``total``."""
    total = report.agg(
        F.lit("total").alias("file_name"), F.sum("size_bytes").alias("size_bytes"),
        F.sum("records").alias("records"),
    )
    return report.unionByName(total)


def schema_table(df: DataFrame) -> DataFrame:
    """The schema of ``df`` as rows (position, column_name, data_type)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string"
    )


def describe_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per numeric column, typed."""
    names = columns or [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)
    ]
    aggs = []
    for n in names:
        value = F.col(n).cast("double")
        aggs += [
            F.count(n).alias(f"{n}__count"), F.avg(value).alias(f"{n}__mean"),
            F.stddev_samp(value).alias(f"{n}__std"), F.min(value).alias(f"{n}__min"),
            F.max(value).alias(f"{n}__max"),
        ]
    parts = ("count", "mean", "std", "min", "max")
    return _long_form(df.agg(*aggs), [
        [("column_name", F.lit(n)), *[(p, F.col(f"{n}__{p}")) for p in parts]] for n in names
    ])
