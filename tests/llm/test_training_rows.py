"""The sample a language model learns from."""

from __future__ import annotations

from collections import Counter

from tripgrid.llm import language


def sample(spark, rows, per_language=20, **options):
    docs = spark.createDataFrame(rows, "text string, lang string")
    return language.training_rows(docs, per_language, 2000, **options)


def test_copies_count_once_and_rare_languages_keep_theirs(spark):
    rows = [("the same text", "en")] * 3000 + [(f"text {i}", "en") for i in range(500)]
    rows += [(f"texte {i}", "fr") for i in range(7)] + [(f"x {i} {k}", f"l{i:02}") for i in range(20) for k in range(25)]
    rows += [(None, "en"), ("", "en"), ("no language", None)]
    got = sample(spark, rows)
    counts = Counter(lang for _, lang in got)
    assert len(counts) == 22 and counts["fr"] == 7 and counts["en"] == 20
    assert all(n >= 15 for lang, n in counts.items() if lang != "fr")
    assert len(set(got)) == len(got)
    assert got == sample(spark, rows[::-1])


def test_most_frequent_languages_are_learned(spark):
    rows = [(f"{lang} {i}", lang) for lang, n in (("aa", 3), ("bb", 9), ("cc", 3)) for i in range(n)]
    assert {lang for _, lang in sample(spark, rows, languages=2)} == {"aa", "bb"}
    assert sample(spark, []) == []
