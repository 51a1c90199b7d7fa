"""Five stages that turn ``documents`` into tokens for training.

Each stage gets what its predecessor kept, as a table read back from the shared folder. The first
four return the columns of ``documents``; the last adds the ids of the text and a check of their
decoding. Columns beyond those of ``documents`` are handed through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrid.llm import byte_bpe, decontaminate, jaccard_join, pii, quality
from tripgrid.llm.common import free_name, stored, table
from tripgrid.llm.queries import BYTE_RANKS, PATTERN, SURROGATE_KEY

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _packed(docs: DataFrame) -> tuple[DataFrame, str]:
    """Whole rows in one column, beside the columns that operators read."""
    row = free_name([*docs.columns, "text", "lang", "source"], "whole_row")
    return docs.select(F.struct(*docs.columns).alias(row), "text", "lang", "source"), row


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    packed, row = _packed(docs)
    return quality.score_quality(packed, [row]).filter("kept").select(f"{row}.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of linked documents, that of the least id."""
    return jaccard_join.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    packed, row = _packed(docs)
    judged = decontaminate.with_verdict(packed, table(spark, sf_dir, "benchmark"), [row])
    return judged.filter(~F.col("contaminated")).select(f"{row}.*")


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; n_chars follows the text."""
    columns = docs.columns
    count = free_name(columns, "n_entities")
    found = pii.replace_pii(docs, SURROGATE_KEY, count)
    if "n_chars" in columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(F.col(count) > 0, length).otherwise(F.col("n_chars")))
    return found.select(*columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``ids`` (little-endian unsigned 32-bit), ``n_tokens`` and ``decoded_sha256``."""
    ids, decoded = free_name(docs.columns, "ids"), free_name(docs.columns, "decoded")
    tokens, check = free_name(docs.columns, "n_tokens"), free_name(docs.columns, "decoded_sha256")
    coded = byte_bpe.encode(docs, BYTE_RANKS, PATTERN, ids=ids)
    back = byte_bpe.decode(coded, BYTE_RANKS, PATTERN, ids=ids, out=decoded)
    return back.select(
        *docs.columns, ids, byte_bpe.n_ids(F.col(ids)).alias(tokens), F.sha2(decoded, 256).alias(check)
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("private_data", private_data),
    ("encoding", encoding),
]
#: SQL has neither the robust estimates nor the surrogates nor the merges
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
