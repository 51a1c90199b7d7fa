"""Benchmark passages in training documents, found with spaced seeds.

A seed is a fixed mask over consecutive words; only its selected positions are hashed, so words in
the ignored positions may differ. Seed hashes of the documents are joined with those of the
benchmark. Around every hit the two word sequences are laid side by side on the hit's diagonal,
and the hit counts if some stretch of ``stretch`` words (the whole item, if that is shorter)
agrees in at least ``share`` of its places.

Everything is DataFrame expressions. The benchmark's seeds are broadcast only when counted to be
at most ``broadcast_rows``; a larger benchmark is joined by shuffle.

Words are the runs between white space, lower-cased, without ASCII punctuation. The masks depend on
the length of the compared stretch and find every pattern of replaced words that the verification
accepts: ``finds_all`` tries them all. An item of fewer than five words says nothing inside a
longer text and flags a document that has its words and no others.

Defined cases: null or empty text or item has no words and matches nothing; repeated documents are
flagged alike; repeated items both count; empty tables flag nothing; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrid.llm.common import join_small, stored, words_of

# fixed masks by length of the stretch (the last also for all longer ones): 1 selects a word, 0 ignores it
MASKS = {
    5: ("1111", "11101", "11011", "10111"),
    6: ("11111", "111101", "111011", "110111", "101111"),
    7: ("11111", "111101", "110111"),
    8: ("111011", "110111"),
    9: ("1111011", "1101111"),
    10: ("111011", "1101011", "1110011"),
    11: ("1101011", "1110011"),
    12: ("11101011", "11010111", "1110010011"),
    13: ("11110111", "1100101111", "11011001011"),
}
SHORTEST = min(MASKS)
LONGEST = max(MASKS)
NUMBERS = {m: k for k, m in enumerate(sorted({m for masks in MASKS.values() for m in masks}))}
WHOLE = len(NUMBERS)
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
REACH = 24
BLOCK = 8


def word_hashes(text: Column) -> Column:
    plain = F.translate(F.lower(text), PUNCTUATION, "")
    return F.transform(words_of(plain), lambda w: F.xxhash64(w))


def finds_all(masks: tuple[str, ...], length: int, replaced: int) -> bool:
    """Whether some mask has a place in ``length`` words that avoids any ``replaced`` of them."""
    places = [{at + k for k, c in enumerate(m) if c == "1"} for m in masks for at in range(length - len(m) + 1)]
    return all(any(not p & set(gone) for p in places) for gone in combinations(range(length), replaced))


def allowed(length: int, share: float) -> int:
    """Words of a stretch that may differ."""
    return length - math.ceil(share * length)


def _seed(mask: str, h: Column, n: Column, i: Column) -> Column:
    """Hash of the selected words of the mask laid at word ``i``; null where it does not fit."""
    chosen = [F.get(h, i + k) for k, c in enumerate(mask) if c == "1"]
    return F.when(i + len(mask) <= n, F.xxhash64(F.lit(NUMBERS[mask]), *chosen))


def _seeds(df: DataFrame, masks: list[str], whole: bool, keep: list[str]) -> DataFrame:
    """One row per position and mask of a table with word hashes ``h``; with ``whole``, one for a short sequence too."""
    at = df.filter(F.size("h") > 0).select(*keep, "h", F.explode(F.sequence(F.lit(0), F.size("h") - 1)).alias("i"))
    seeds = [_seed(m, F.col("h"), F.size("h"), F.col("i")) for m in masks]
    if whole:
        seeds.append(F.when((F.size("h") < SHORTEST) & (F.col("i") == 0), F.xxhash64(F.lit(WHOLE), "h")))
    return at.select(*keep, "h", "i", F.explode(F.array(*seeds)).alias("seed")).filter(F.col("seed").isNotNull())


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    row: str,
    stretch: int = 13,
    share: float = 0.8,
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """(row, item_id, position, matched): verified overlaps of documents with benchmark items.

    ``row`` names a column that tells documents apart; ``position`` is the document word where the
    first compared place lies, ``matched`` the most agreeing words in a stretch. A ``stretch`` and
    ``share`` whose accepted patterns the masks do not all find are refused.
    """
    if stretch < LONGEST or any(not finds_all(m, n, allowed(n, share)) for n, m in MASKS.items()):
        raise ValueError("the masks do not find everything that would be accepted")
    if allowed(stretch, share) > allowed(LONGEST, share):
        raise ValueError("the longest masks allow fewer replaced words than the stretch")
    items = stored(benchmark.select("item_id", word_hashes(F.col("text")).alias("h")).filter(F.size("h") > 0), "items")
    length = F.least(F.size("h"), F.lit(LONGEST))
    # at most as many rows as there are lengths with masks of their own
    lengths = sorted(r["n"] for r in items.select(length.alias("n")).distinct().collect())
    masks = sorted({m for n in lengths for m in MASKS.get(n, ())})
    whole = any(n < SHORTEST for n in lengths)
    per_length = [
        _seeds(items.filter(length == n), list(MASKS.get(n, ())), n < SHORTEST, ["item_id"]) for n in lengths
    ] or [_seeds(items, list(MASKS[LONGEST]), False, ["item_id"])]
    span = max(map(len, masks), default=SHORTEST)
    seeds = stored(
        reduce(DataFrame.unionByName, per_length).select("item_id", F.size("h").alias("size"), F.col("i").alias("p"), "seed"), "seeds"
    )
    hashed = docs.select(F.col(row), word_hashes(F.col("text")).alias("h"))
    ours = _seeds(hashed, masks or list(MASKS[LONGEST]), whole, [row])
    hits = join_small(
        ours.withColumnRenamed("seed", "ours"), seeds, F.col("ours") == F.col("seed"), "inner", broadcast_rows
    )
    i, p = F.col("i"), F.col("p")
    first = F.greatest(F.lit(0), i - REACH, i - p)
    last = F.least(F.size("h"), i + span + REACH, i - p + F.col("size"))
    spots = hits.select(
        row, "item_id", (i - p).alias("diagonal"), F.floor(i / BLOCK).alias("block"),
        F.struct(first.alias("first"), F.slice("h", first + 1, last - first).alias("ours")).alias("spot"),
    )
    once = spots.groupBy(row, "item_id", "diagonal", "block").agg(F.min("spot").alias("spot"))
    both = join_small(
        once.withColumnRenamed("item_id", "item"), items, F.col("item") == F.col("item_id"), "inner", broadcast_rows // 20
    )
    theirs = F.slice("h", F.col("spot.first") - F.col("diagonal") + 1, F.size("spot.ours"))
    agree = both.select(
        row, "item_id", F.col("spot.first").alias("position"),
        F.least(F.lit(stretch), F.size("h")).alias("need"),
        F.zip_with("spot.ours", theirs, lambda a, b: F.when(a == b, 1).otherwise(0)).alias("same"),
    )
    starts = F.sequence(F.lit(1), F.size("same") - F.col("need") + 1)
    matched = F.array_max(
        F.transform(starts, lambda s: F.aggregate(F.slice("same", s, F.col("need")), F.lit(0), lambda x, y: x + y))
    )
    scored = agree.withColumn("matched", F.when(F.size("same") >= F.col("need"), matched))
    return scored.filter(F.col("matched") >= F.ceil(F.lit(share) * F.col("need"))).select(row, "item_id", "position", "matched")


def contaminated(docs: DataFrame, benchmark: DataFrame, row: str, **options) -> DataFrame:
    """One row for each document that holds a benchmark passage: row, n_items, items, matched."""
    found = overlaps(docs, benchmark, row, **options)
    per_item = found.groupBy(row, "item_id").agg(F.max("matched").alias("matched"))
    return per_item.groupBy(row).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sort_array(F.collect_list("item_id")).alias("items"),
        F.max("matched").cast("long").alias("matched"),
    )


def with_verdict(docs: DataFrame, benchmark: DataFrame, keep: list[str], broadcast_flags: int = 500_000, **options) -> DataFrame:
    """``keep`` and contaminated, n_items, items and matched; documents are told apart by ``keep`` and text."""
    whole = docs.select(F.struct(*keep).alias("row"), "text")
    keyed = whole.withColumn("key", F.struct(F.xxhash64("row", "text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b")))
    flags = stored(contaminated(keyed, benchmark, "key", **options).withColumnRenamed("key", "flag"), "contaminated")
    joined = join_small(keyed.drop("text"), flags, F.col("key") == F.col("flag"), "left", broadcast_flags)
    none = F.array().cast(flags.schema["items"].dataType)
    return joined.select(
        "row.*",
        F.col("flag").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("matched", F.lit(0)).alias("matched"),
    )
