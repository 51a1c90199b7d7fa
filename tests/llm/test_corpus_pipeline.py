"""The pipeline's stages, each on odd rows, and the whole against the stages one by one."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm import brute
from tripgrid.llm import byte_bpe, pii, queries

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    """The small documents with odd rows and further columns of clashing names."""
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (10**6, "", "en", "src0", 0), (10**6 + 1, "x " * 3000, None, "src0", 6000)], table.schema
    )
    rows = table.unionByName(odd).unionByName(table.filter("doc_id = 5"))
    names = ("kept", "row", "ids", "n_entities", "whole_row", "n_tokens", "k1", "label", "flag", "items")
    return rows.withColumns({n: F.lit(f"own {n}") for n in names})


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_order_of_stages():
    assert list(STAGES) == ["quality_rules", "near_duplicates", "decontamination", "private_data", "encoding"]


def test_filters_return_whole_rows(spark, docs):
    before = rows_of(docs)
    for name in ("quality_rules", "near_duplicates", "decontamination"):
        out = STAGES[name](spark, docs, SMALL)
        assert out.columns == docs.columns, name
        left = rows_of(out)
        assert 0 < len(left) < len(before) and set(left) <= set(before), name
        assert STAGES[name](spark, docs.limit(0), SMALL).count() == 0


def test_quality_stage_drops_what_the_base_rules_reject(spark, docs):
    left = {r["doc_id"] for r in STAGES["quality_rules"](spark, docs, SMALL).collect()}
    for r in docs.collect():
        n, _, _, _, repeat = brute.statistics(r["text"])
        if n < 20 or 100 * repeat > 30 * n:
            assert r["doc_id"] not in left


def test_near_duplicates_keep_one_of_each_group(spark, docs):
    kept = docs.collect()
    order = sorted(range(len(kept)), key=lambda i: (kept[i]["doc_id"] is not None, kept[i]["doc_id"] or 0))
    found = brute.components([kept[i]["text"] for i in order])
    want = sorted(str(kept[order[i]]["doc_id"]) for i, (n, c) in enumerate(found) if c == i or not n)
    assert sorted(str(r["doc_id"]) for r in STAGES["near_duplicates"](spark, docs, SMALL).collect()) == want


def test_private_data_changes_texts_only(spark, docs):
    out = STAGES["private_data"](spark, docs, SMALL)
    assert out.columns == docs.columns
    text, chars = docs.columns.index("text"), docs.columns.index("n_chars")
    rest = lambda r: tuple(x for i, x in enumerate(r) if i not in (text, chars))
    assert sorted(map(str, map(rest, rows_of(out)))) == sorted(map(str, map(rest, rows_of(docs))))
    entities = {v for r in docs.collect() for _, _, _, v in pii.find_spans(r["text"])}
    for r in out.collect():
        assert not entities & {v for _, _, _, v in pii.find_spans(r["text"])}
        assert r["text"] is None or r["doc_id"] is None or r["n_chars"] == len(r["text"])


def test_encoding_round_trip(spark, docs):
    out = STAGES["encoding"](spark, docs, SMALL)
    bpe = byte_bpe.codec(queries.BYTE_RANKS, queries.PATTERN)
    reference = tiktoken.Encoding("own", pat_str=queries.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    assert out.columns == [*docs.columns, "_ids", "_n_tokens", "decoded_sha256"]
    for r in out.collect():
        ids = np.frombuffer(r["_ids"], "<u4")
        assert ids.tolist() == reference.encode_ordinary(r["text"] or "") and r["_n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_run_is_the_stages_in_order(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for stage in STAGES.values():
        docs = stage(spark, docs, SMALL)
    whole = corpus_pipeline.run(spark, SMALL)
    assert whole.columns == docs.columns and rows_of(whole) == rows_of(docs)
