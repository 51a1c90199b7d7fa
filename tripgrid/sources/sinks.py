"""Batch sinks."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrid.operators import quality
from tripgrid.operators.analysis import hash_sample

ROWS_PER_FILE = 500_000


def write_parquet(
    df: DataFrame,
    path: str,
    rows_per_file: int | None = None,
    compact: bool = False,
    partition_by: tuple[str, ...] = (),
) -> None:
    """Overwrite ``path`` with Parquet.

    ``rows_per_file`` caps file length in the writer, without counting or moving rows.
    ``compact`` adds a rebalancing shuffle that merges small and splits large partitions to
    the session's advisory size; leave it off where the plan ends in a shuffle already.
    """
    if compact:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def copy_table(spark: SparkSession, source: str, target: str, fmt: str = "parquet") -> None:
    """Copy a table between filesystems; CSV keeps its text as it is."""
    if fmt == "csv":
        write_csv(spark.read.option("header", True).csv(source), target)
    else:
        spark.read.format(fmt).load(source).write.mode("overwrite").format(fmt).save(target)


def readable_export(
    df: DataFrame, folder: str, sample_rows: int = 1000, full: bool = True
) -> None:
    """Schema, statistics, a CSV sample and, unless ``full`` is off, a CSV copy of a table.

    The full copy is written first, by all tasks, and the other parts are derived from it, so the
    table is computed once and nothing is kept on executors. Without it, statistics are one
    aggregate and the sample is taken from as few partitions as hold it; a limit inside the plan
    would make every task of a large table send its share. Only bounded parts become one file.
    """
    spark, kept = df.sparkSession, df
    if full:
        write_csv(df, f"{folder}/full")
        kept = spark.read.schema(df.schema).option("header", True).csv(f"{folder}/full")
    write_csv(quality.schema_table(df).coalesce(1), f"{folder}/schema")
    write_csv(quality.describe_numeric(kept), f"{folder}/statistics")
    sample = spark.createDataFrame(kept.take(sample_rows), df.schema)
    write_csv(sample.coalesce(1), f"{folder}/sample")


def write_derived_tables(
    cells: DataFrame,
    statistics: Callable[[DataFrame], DataFrame],
    training: Callable[[DataFrame], DataFrame],
    folder: str,
    sample_rows: int = 10_000,
) -> None:
    """The aggregated, per-cell and training tables, and a repeatable CSV sample.

    ``cells`` is computed once; the other tables are derived from what was written.
    """
    spark = cells.sparkSession
    write_parquet(cells, f"{folder}/aggregated")
    written = spark.read.schema(cells.schema).parquet(f"{folder}/aggregated")
    write_parquet(statistics(written), f"{folder}/cell_statistics")
    write_parquet(training(written), f"{folder}/training")
    stored = spark.read.parquet(f"{folder}/training")
    sample = hash_sample(stored, sample_rows, ["cell_id", "hour_bucket"])
    write_csv(sample, f"{folder}/training_sample")


def write_json_record(spark: SparkSession, record: dict, path: str) -> None:
    """A small driver-side record as one JSON text file on the table filesystem."""
    text = spark.createDataFrame([(json.dumps(record, sort_keys=True),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(path)


def read_json_record(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).select(F.col("value")).first()[0])
