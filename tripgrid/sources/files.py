"""File sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripgrid import profiles
from tripgrid.schemas import RAW_TRIP


def read_raw_csv(
    spark: SparkSession, path: str, name_filter: str | None = None, schema: StructType = RAW_TRIP
) -> DataFrame:
    """Raw trip files with a header under a fixed schema, malformed lines dropped.

    ``path`` may be a folder or glob on any filesystem and ``name_filter`` keeps matching
    file names only, so no driver-side listing is needed.
    """
    reader = spark.read.schema(schema).option("header", True).option("mode", "DROPMALFORMED")
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV whose types Spark finds in an extra pass; prefer ``read_raw_csv`` for big input."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_clean(spark: SparkSession, pattern: str) -> DataFrame:
    """All clean trip tables matching a glob, as one frame."""
    return spark.read.parquet(pattern)


def read_features(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """Feature table and the ordered names of its model inputs."""
    return spark.read.parquet(path), list(profiles.FEATURE_COLUMNS)


def union_all(tables: list[DataFrame]) -> DataFrame:
    """Rows of all tables by column name; duplicates stay."""
    first, *rest = tables
    for table in rest:
        first = first.unionByName(table)
    return first
