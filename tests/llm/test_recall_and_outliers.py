"""What masks must find and robust estimates must reject, over all patterns and small groups."""

from __future__ import annotations

import random
from itertools import combinations

import pytest

from tripgrid.llm import decontaminate, quality

SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("length", sorted(decontaminate.MASKS))
def test_masks_find_every_accepted_pattern(length):
    replaced = decontaminate.allowed(length, 0.8)
    assert decontaminate.finds_all(decontaminate.MASKS[length], length, replaced)
    assert not decontaminate.finds_all(("1" * length,), length, 1)


def flagged(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {r["doc_id"] for r in decontaminate.with_verdict(docs, bench, ["doc_id"]).collect() if r["contaminated"]}


@pytest.mark.parametrize("length", [5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 20])
def test_every_accepted_pattern_is_flagged(spark, length):
    """All patterns of replaced words of an item, within other words; one more replaced word is not flagged."""
    rng = random.Random(length)
    item = [f"w{i}" for i in range(length)]
    stretch = min(length, 13)
    allowed = decontaminate.allowed(stretch, 0.8)
    texts, wanted = [], set()
    for n in range(allowed + 2):
        patterns = list(combinations(range(length), n))
        for gone in rng.sample(patterns, min(len(patterns), 80)):
            words = [f"x{rng.randrange(10**6)}" if i in gone else w for i, w in enumerate(item)]
            around = [f"y{rng.randrange(10**6)}" for _ in range(rng.randrange(4))]
            best = max(
                sum(i not in gone for i in range(s, s + stretch)) for s in range(length - stretch + 1)
            )
            if best >= stretch - allowed:
                wanted.add(len(texts))
            texts.append(" ".join([*around, *words, *around]))
    assert flagged(spark, texts, [" ".join(item)]) == wanted and wanted


def test_items_of_few_words_flag_whole_documents_only(spark):
    texts = ["The quick, brown fox", "see the quick brown fox run", "the quick brown", "quick", "", None, "fox"]
    assert flagged(spark, texts, ["the quick brown fox", "Quick!", "", None]) == {0, 3}
    assert flagged(spark, texts, []) == set() and flagged(spark, [], ["a b c d e"]) == set()


def test_a_very_long_text_is_searched_to_its_end(spark):
    item = [f"w{i}" for i in range(15)]
    text = " ".join([*[f"z{i % 977}" for i in range(60_000)], *item[:7], "other", *item[8:]])
    assert flagged(spark, [text, text[:-40]], [" ".join(item)]) >= {0}


def documents(rng, n, source, odd=0):
    rows = []
    for k in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(60, 140))]
        if k < odd:
            words = [w + "$#%" * 8 for w in words]
        rows.append((" ".join(words), "en", source))
    return rows


def rejected(spark, rows):
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    return {r["doc_id"] for r in quality.score_quality(docs, ["doc_id"]).collect() if not r["kept"]}


def test_outliers_of_a_group_hardly_large_enough(spark):
    """55 usable documents of which 10 are outliers: all ten go and no other."""
    assert rejected(spark, documents(random.Random(1), 55, "s", odd=10)) == set(range(10))


def test_small_groups_are_judged_by_their_language(spark):
    rng = random.Random(2)
    rows = documents(rng, 5, "few", odd=2) + documents(rng, 80, "many") + documents(rng, 30, "some", odd=1)
    assert rejected(spark, rows) == {0, 1, 85}


def test_small_languages_are_judged_by_all_documents(spark):
    rng = random.Random(3)
    rows = documents(rng, 70, "many") + [(t, "xx", s) for t, _, s in documents(rng, 6, "few", odd=2)] + [(t, None, None) for t, _, _ in documents(rng, 4, "", odd=1)]
    assert rejected(spark, rows) == {70, 71, 76}


def test_hardly_any_documents_reject_nothing(spark):
    assert rejected(spark, documents(random.Random(4), 7, "s", odd=3)) == set()


def test_three_starts_settle_at_the_least_determinant(spark):
    """A quarter of outliers, close to each other, moves the moments of all documents but not the result."""
    rows = documents(random.Random(5), 200, "s", odd=45)
    assert rejected(spark, rows) == set(range(45))


def test_a_very_long_text_is_counted_whole(spark):
    text = " ".join(f"w{i % 5000}x{i // 5000}" for i in range(120_000)) + "\nlast line\nlast line"
    docs = spark.createDataFrame([(0, text, "en", "s"), (1, None, None, None)], SCHEMA)
    out = {r["doc_id"]: r for r in quality.score_quality(docs, ["doc_id"]).collect()}
    assert (out[0]["n_words"], out[0]["n_dup_lines"], out[0]["base_failed"]) == (120_004, 1, False)
    assert out[1]["n_words"] == 0 and out[1]["base_failed"] and not out[1]["kept"]
