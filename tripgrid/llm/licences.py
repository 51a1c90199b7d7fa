"""Licence labels of documents, from a positional index of the templates' rare words.

Base labels mark places where a fixed phrase stands word by word. The method finds the notices of
``TEMPLATES``: the licence words of every document (words of a template that are no ``COMMON``
words) are kept with their positions, and their inverse document frequency is counted over all
documents. For each template that has none of its mandatory words missing, the document's
``rarest`` licence words of highest IDF and the words of the mandatory key phrases are looked up in
the template's postings. Every lookup names the place where the template would begin; postings
that agree on it are intersected, and the template is found where at least ``agreeing`` of the rare
words (or all of a shorter list) and every word of every key phrase stand in place.

``score`` is the share of the looked-up words, weighted by IDF, that stand in place for the best
template, and at least 0.5 where a base phrase stands. Everything is DataFrame expressions. What
the driver gets is one count for each word of the templates; postings are a literal of that size.

A document's lookups number its licence words times the postings of a word, so long texts and
texts of licence words alone grow in proportion. Found places are joined back by the number a
document got when it was written; a broadcast happens only below a counted number of documents.

Defined cases: null text counts as empty; without words there are no places and no labels; a
phrase standing several times counts each time, a label once; repeated rows are judged alike; an
empty table gives an empty result; other columns are handed through or ignored.
"""

from __future__ import annotations

import json
import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrid.llm.common import join_small, stored

# fixed values: phrases and their labels
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


class Template(NamedTuple):
    label: str
    text: str
    keys: tuple[str, ...]


# fixed values: notices by which public licences ask to be named, without punctuation
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", ("required by applicable law", "distributed on an as is basis")),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("redistribute it and or modify it", "free software foundation")),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", ("gnu affero general public license",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge", "associated documentation files")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("source and binary forms", "following conditions are met")),
    Template("bsd-3-clause", "may be used to endorse or promote products derived from this software without specific prior written permission", ("endorse or promote products", "prior written permission")),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("epl-2.0", "made available under the terms of the eclipse public license 2 0", ("eclipse public license 2 0",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    Template("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
)
#: words too common to be looked up; they are not checked in place either
COMMON = frozenset("a an and any are as at be by can for from in is it may met of on or that the this to under use used with without you".split())
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: places of a template's words in one 64-bit mask
MOST_WORDS = 62


def vocabulary(templates: tuple[Template, ...] = TEMPLATES) -> list[str]:
    return sorted({w for t in templates for w in t.text.split()} - COMMON)


def words(text: Column) -> Column:
    """Words as they are; only the letters A-Z are to be read as lower case."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != "")


def _is(word: Column, *wanted: str) -> Column:
    """Whether a word is one of ``wanted`` (ASCII); other letters that lower-case to ASCII don't count."""
    return F.lower(word).isin(*wanted) & (F.octet_length(word) == F.length(word))


def _places(phrase: str, label: str) -> Column:
    """Where the words of a phrase stand one after another, from ``hits`` and ``words``."""
    head, *rest = phrase.split()

    def stands(h: Column) -> Column:
        found = h["w"] == head
        for k, w in enumerate(rest, 1):
            found &= F.coalesce(_is(F.get("words", h["at"] + k), w), F.lit(False))
        return found

    return F.transform(F.filter("hits", stands), lambda h: F.struct(F.lit(label).alias("label"), h["at"].cast("long").alias("at")))


def licence_words(docs: DataFrame, keep: list[str], templates: tuple[Template, ...]) -> DataFrame:
    """Written: ``number``, ``row`` (``keep``), ``n_words``, base ``places`` and the licence words with their positions."""
    base_words = sorted({w for p in PHRASES for w in p.split()[:1]})
    known = vocabulary(templates) + [w for w in base_words if w not in vocabulary(templates)]
    first = docs.select(F.struct(*keep).alias("row"), words(F.col("text")).alias("words"))
    hits = F.array_compact(
        F.transform("words", lambda w, i: F.when(_is(w, *known), F.struct(F.lower(w).alias("w"), i.alias("at"))))
    )
    second = first.select("row", "words", F.size("words").cast("long").alias("n_words"), hits.alias("hits"))
    places = [_places(phrase, label) for phrase, label in PHRASES.items()]
    listed = second.select("row", "n_words", F.flatten(F.array(*places)).alias("places"), "hits")
    return stored(listed.withColumn("number", F.monotonically_increasing_id()), "licence-words")


def document_frequencies(found: DataFrame) -> dict[str, int]:
    """How many documents hold each licence word: no more rows than the templates have words."""
    seen = found.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["w"]))).alias("w"))
    return {r["w"]: r["n"] for r in seen.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}


def index(templates: tuple[Template, ...], total: int, frequency: dict[str, int]) -> list[dict]:
    """The templates' postings with IDF, each template's distinct words by falling IDF."""
    rows = []
    for number, t in enumerate(templates):
        plain = t.text.split()
        at = [i for i, w in enumerate(plain) if w not in COMMON]
        if len(at) > MOST_WORDS:
            raise ValueError(f"a template has at most {MOST_WORDS} words beside common ones")
        must = 0
        for key in t.keys:
            parts = key.split()
            start = next(i for i in range(len(plain)) if plain[i : i + len(parts)] == parts)
            must |= sum(1 << at.index(i) for i in range(start, start + len(parts)) if i in at)
        idf = {w: round(math.log((total + 1) / (frequency.get(w, 0) + 1)) + 1, 9) for w in vocabulary((t,))}
        ranked = sorted(idf, key=lambda w: (-idf[w], w))
        postings = [
            {"w": plain[i], "t": number, "o": i, "bit": 1 << k, "idf": idf[plain[i]], "key": bool(must >> k & 1)} for k, i in enumerate(at)
        ]
        rows.append(
            {"ranked": ranked, "mandatory": sorted({p["w"] for p in postings if p["key"]}), "must": must, "postings": postings}
        )
    return rows


INDEX = (
    "array<struct<ranked: array<string>, mandatory: array<string>, must: bigint, "
    "postings: array<struct<w: string, t: int, o: int, bit: bigint, idf: double, key: boolean>>>>"
)


def matches(found: DataFrame, listed: list[dict], rarest: int, agreeing: int) -> DataFrame:
    """(number, t, start, score): places where a template's rare words agree and its key phrases stand."""
    templates = F.from_json(F.lit(json.dumps(listed)), INDEX)
    mine = found.filter(F.size("hits") > 0).select("number", "hits", F.array_distinct(F.transform("hits", lambda h: h["w"])).alias("mine"))
    possible = F.filter(templates, lambda t: F.size(F.array_except(t["mandatory"], F.col("mine"))) == 0)
    opened = mine.select("number", "hits", "mine", F.explode(possible).alias("t"))
    ranked = opened.select("number", "hits", "t", F.slice(F.array_intersect("t.ranked", "mine"), 1, rarest).alias("rare"))
    looked = F.filter("t.postings", lambda p: p["key"] | F.array_contains("rare", p["w"]))
    asked = ranked.select(
        "number", "hits", "t.must", "rare", looked.alias("looked"),
        F.aggregate(looked, F.lit(0.0), lambda s, p: s + p["idf"]).alias("weight"),
    )
    places = asked.select("number", "must", "looked", "rare", "weight", F.explode("hits").alias("h")).select(
        "number", "must", "weight", F.size("rare").alias("n_rare"), F.col("h.at").alias("at"), "rare",
        F.explode(F.filter("looked", lambda p: p["w"] == F.col("h.w"))).alias("p"),
    )
    # a word and a start name one posting, so equal words at one start lie at different offsets
    rank = F.array_position("rare", F.col("p.w"))
    agreed = places.groupBy("number", "p.t", (F.col("at") - F.col("p.o")).alias("start")).agg(
        F.bit_or("p.bit").alias("bits"),
        F.sum("p.idf").alias("inplace"),
        F.bit_or(F.when(rank > 0, F.pow(F.lit(2.0), rank - 1).cast("long"))).alias("rare_bits"),
        F.first("must").alias("must"), F.first("weight").alias("weight"), F.first("n_rare").alias("n_rare"),
    )
    enough = F.bit_count(F.coalesce("rare_bits", F.lit(0))) >= F.least(F.lit(agreeing), F.col("n_rare"))
    stands = F.col("bits").bitwiseAND(F.col("must")) == F.col("must")
    score = F.least(F.lit(1.0), F.round(F.col("inplace") / F.col("weight"), 6))
    return agreed.filter(stands & enough).select("number", "t", "start", score.alias("score"))


def scan(
    docs: DataFrame,
    keep: list[str],
    templates: tuple[Template, ...] = TEMPLATES,
    rarest: int = 8,
    agreeing: int = 3,
    broadcast_rows: int = 500_000,
) -> DataFrame:
    """``keep`` and n_words, n_base, first_word, last_word, base_labels, labels, score of every document.

    ``docs`` needs text.
    """
    found = licence_words(docs, keep, templates)
    listed = index(templates, found.count(), document_frequencies(found))
    names = F.array(*[F.lit(t.label) for t in templates])
    per_document = stored(
        matches(found, listed, rarest, agreeing).groupBy(F.col("number").alias("of")).agg(
            F.collect_set(F.get(names, F.col("t"))).alias("more"), F.max("score").alias("best")
        ),
        "licence-matches",
    )
    joined = join_small(found.drop("hits"), per_document, F.col("number") == F.col("of"), "left", broadcast_rows)
    labels = F.transform("places", lambda p: p["label"])
    starts = F.transform("places", lambda p: p["at"])
    base = F.when(F.size("places") > 0, F.lit(0.5)).otherwise(F.lit(0.0))

    def text(array: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(array)), ",")

    return joined.select(
        "row.*",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        text(labels).alias("base_labels"),
        text(F.concat(labels, F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
        F.greatest(base, F.coalesce("best", F.lit(0.0))).alias("score"),
    )
