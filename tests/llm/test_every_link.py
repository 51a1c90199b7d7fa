"""The join's links between all different texts, against all pairs."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tripgrid.llm import jaccard_join


def texts_of(seed):
    rng = random.Random(seed)
    base = [" ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(60, 140))) for _ in range(12)]
    out = [None, "", "one two", "one two", base[0], base[0]]
    for b in base:
        for _ in range(rng.randrange(1, 9)):
            words = b.split()
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(1000)}"
            out.append(" ".join(words))
    return out


def plain_links(texts):
    """doc index -> number of different other sets it is linked to."""
    sets = [brute.shingles(t) for t in texts]
    different = sorted({s for s in sets if s}, key=sorted)
    linked = Counter()
    for i, a in enumerate(different):
        for b in different[i + 1 :]:
            if 100 * len(a & b) >= 80 * len(a | b):
                linked[a] += 1
                linked[b] += 1
    return [linked[s] for s in sets], sum(linked.values()) // 2


@pytest.mark.parametrize("options", [{}, {"leaf_points": 3, "broadcast_rows": 0}, {"leaf_shingles": 100}])
def test_every_link_is_found_once(spark, options):
    texts = texts_of(len(options))
    counts, total = plain_links(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["n_links"] for r in jaccard_join.link_counts(docs, ["doc_id"], **options).collect()}
    assert [out[i] for i in range(len(texts))] == counts and total > 20
    _, links = jaccard_join.near_duplicates(docs, ["doc_id"], every_link=True, **options)
    assert links.count() == total == links.select("a", "b").distinct().count()
    assert links.filter("a >= b or similarity < 0.8").count() == 0


def test_near_copies_of_one_text_are_all_linked(spark):
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join([*words, f"end{k}"]) for k in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert jaccard_join.near_duplicates(docs, ["doc_id"], every_link=True)[1].count() == 15
    assert jaccard_join.link_counts(docs, ["doc_id"]).filter(F.col("n_links") != 5).count() == 0


def test_links_of_nothing(spark):
    docs = spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")
    assert {(r["n_shingles"], r["n_links"]) for r in jaccard_join.link_counts(docs, ["doc_id"]).collect()} == {(0, 0)}
    assert jaccard_join.link_counts(docs.limit(0), ["doc_id"]).collect() == []
