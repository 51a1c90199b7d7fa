"""One registered query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrid.llm import (
    byte_bpe, conversations, decontaminate, filter_audit, html_text, jaccard_join, language, licences, lm_score, pii, quality, substrings,
    token_files, twins,
)
from tripgrid.llm.common import table

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
SURROGATE_KEY = "corpus-2024"  # a deployment passes its own
PATTERN = public_tokenizers.PATTERN
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = pages.select("page_id", "url", html_text.extract_main_text(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.encode(docs, BYTE_RANKS, PATTERN).drop("text")
    decoded = byte_bpe.decode(coded, BYTE_RANKS, PATTERN)
    return decoded.select(
        "doc_id",
        byte_bpe.n_ids(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = token_files.write_shards(docs, WORD_TOKENIZER, END_ID)
    read = token_files.read_documents(manifest)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_score.score(docs, table(spark, sf_dir, "labels"), ["doc_id"])


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out.alias("held_out"))
    fitted = language.fit(docs.filter(~F.col("held_out")))
    found = docs.select("doc_id", "held_out", language.predict(F.col("text"), fitted).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.with_verdict(docs, table(spark, sf_dir, "benchmark"), ["doc_id"])


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_pii(docs, SURROGATE_KEY)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.score_quality(docs, ["doc_id"])


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substrings.remove_repeats(docs, ["doc_id"])
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations"))).summary


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return filter_audit.audit(docs, table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_token_files": op4_token_files,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_language_id": op6_language_id,
    "op7_decontamination": op7_decontamination,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op9_quality_rules": op9_quality_rules,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_license_scans": op11_license_scans,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_filter_audit": op13_filter_audit,
}
#: the other operators are tested against plain versions in tests/llm
ORACLE_SQL: dict[str, str] = {
    "op2_ngram_jaccard_join": twins.JACCARD_JOIN,
    "op10_substring_dedup": twins.REPEATED_PASSAGES,
    "op13_filter_audit": twins.FILTER_AUDIT,
}
