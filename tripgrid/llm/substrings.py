"""Repeated passages removed: seeds from winnowed anchors, extended both ways.

A window is ``WINDOW`` consecutive words. Of the runs of ``SEED`` words inside a window the one
with the least hash is its anchor (the leftmost of equals), so equal windows have equal anchors.
Consecutive windows with the same anchor form one extension: the stretch of words that reaches
from the anchor both ways as far as its windows do.

Documents meet on anchors:

1. Anchors that occur once cannot lie in a repeat. All others are found by counting, which also
   tells whether all extensions around an anchor are the same words.
2. An extension whose words occur twice or more is repeated as a whole.
3. The remaining ones, at the borders of repeats, are compared window by window with one copy of
   each different extension around their anchor.

So work grows with the text and with the different extensions, never with pairs of occurrences.
The union of the repeated windows of a text are its maximal repeats; their words go.

Defined cases: null text has no words; texts shorter than a window lose nothing; a repeated row
repeats all its windows and loses them, and so do all rows of equal text; repeats inside one text
count; an empty table gives an empty result; other columns are handed through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgrid.llm.common import Rolling, Words, mixed, stored

WINDOW = 35
SEED = 12
PER_WINDOW = WINDOW - SEED + 1
TEXTS_AT_ONCE = 200


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost least value in each stretch of ``width``."""
    at, reach = np.arange(len(values)), 1

    def better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(values[a] <= values[b], a, b)

    while 2 * reach <= width:
        at = better(at[:-reach], at[reach:])
        reach *= 2
    rest = width - reach
    return better(at[: len(at) - rest], at[rest:]) if rest else at


class Extensions:
    """Extensions of a list of texts: anchor, words, text, first window, number of windows."""

    def __init__(self, words: Words, texts: list[str | None]) -> None:
        split = [t.encode().split() if t else [] for t in texts]
        sizes = np.array([len(x) for x in split], np.int64)
        flat = words.hashes([w for x in split for w in x])
        self.rolling = Rolling(flat)
        self.first = np.cumsum(sizes) - sizes
        empty = np.empty(0, np.int64)
        self.text = self.start = self.windows = empty
        self.anchor = self.words = empty.astype(np.uint64)
        if len(flat) < WINDOW:
            return
        at = np.arange(len(flat) - SEED + 1)
        seeds = self.rolling.of(at, at + SEED)
        least = _least(seeds, PER_WINDOW)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        fits = np.arange(len(least)) + WINDOW <= (self.first + sizes)[owner[: len(least)]]
        s = np.flatnonzero(fits)
        if not len(s):
            return
        new = np.concatenate(([True], (np.diff(least[s]) != 0) | (np.diff(s) > 1)))
        begin = np.flatnonzero(new)
        self.windows = np.diff(np.append(begin, len(s)))
        at = s[begin]
        self.text = owner[at]
        self.start = at - self.first[self.text]
        self.anchor = seeds[least[at]]
        lead = (least[at] - at).astype(np.uint64)
        self.words = mixed(self.rolling.of(at, at + self.windows - 1 + WINDOW) + lead)

    def window_hashes(self, text: int, start: int, windows: int) -> np.ndarray:
        at = self.first[text] + start + np.arange(windows)
        return self.rolling.of(at, at + WINDOW)


def _extensions(docs: DataFrame) -> DataFrame:
    """(k1, k2, anchor, words, start, windows) of all texts; (k1, k2) tells texts apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for k in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(k, TEXTS_AT_ONCE)
                x = Extensions(words, part.column("text").to_pylist())
                k1, k2 = (part.column(c).to_numpy()[x.text] for c in ("k1", "k2"))
                columns = [k1, k2, x.anchor.view(np.int64), x.words.view(np.int64), x.start.astype(np.int32), x.windows.astype(np.int32)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["k1", "k2", "anchor", "words", "start", "windows"]
                )

    return docs.mapInArrow(run, "k1 long, k2 long, anchor long, words long, start int, windows int")


def _split_windows(docs: DataFrame) -> DataFrame:
    """(k1, k2, anchor, window, start, single) for the extensions listed in ``borders``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for k in range(batch.num_rows):
                part = batch.slice(k, 1)
                x = Extensions(words, part.column("text").to_pylist())
                spans = part.column("borders").to_pylist()[0]
                n = np.array([s["windows"] for s in spans])
                found = [x.window_hashes(0, s["start"], s["windows"]) for s in spans]
                starts = np.concatenate([s["start"] + np.arange(s["windows"]) for s in spans])
                one = lambda c, size=int(n.sum()): np.full(size, part.column(c)[0].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one("k1")), pa.array(one("k2")),
                        pa.array(np.repeat(np.array([s["anchor"] for s in spans], np.int64), n)),
                        pa.array(np.concatenate(found).view(np.int64)), pa.array(starts.astype(np.int32)),
                        pa.array(np.repeat(np.array([s["single"] for s in spans], bool), n)),
                    ],
                    names=["k1", "k2", "anchor", "window", "start", "single"],
                )

    return docs.mapInArrow(run, "k1 long, k2 long, anchor long, window long, start int, single boolean")


def _cut(docs: DataFrame, out: list[str]) -> DataFrame:
    """``out``, n_words, n_removed and kept_text, given ``spans`` (start, windows) of repeated windows."""
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
    schema = T.StructType([*docs.select(*out).schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(k, TEXTS_AT_ONCE)
                total, removed, kept = [], [], []
                for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True):
                    words = text.encode().split() if text else []
                    total.append(len(words))
                    if spans:
                        edge = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edge, [s["start"] for s in spans], 1)
                        np.add.at(edge, [s["start"] + s["windows"] - 1 + WINDOW for s in spans], -1)
                        stay = np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()
                        words = [words[i] for i in stay]
                    removed.append(total[-1] - len(words))
                    kept.append(b" ".join(words).decode())
                columns = [part.column(c) for c in out]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                    names=[*out, "n_words", "n_removed", "kept_text"],
                )

    return docs.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and n_words, n_removed and kept_text for every document; ``docs`` has ``text``."""
    row = "row"
    whole = docs.select(F.struct(*keep).alias(row), "text")
    k1, k2 = F.xxhash64("text", row), F.xxhash64(F.lit(1), "text")
    keyed = whole.select(row, "text", k1.alias("k1"), k2.alias("k2"))
    key = ["k1", "k2"]
    found = _extensions(keyed.select(*key, "text"))

    # results that are joined back are written first: only then can adaptive execution split a hot
    # anchor, since both sides of the join come straight from a shuffle
    shared = stored(
        found.select("anchor", "words")
        .groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"), F.min("words").alias("a"), F.max("words").alias("b"))
        .filter("n > 1")
        .select(F.col("anchor").alias("shared"), (F.col("a") != F.col("b")).alias("differ")),
        "shared",
    )
    met = stored(found.join(shared, F.col("anchor") == F.col("shared")).drop("shared"), "anchors")

    # around these anchors the extensions differ; one copy of each stands for all
    kinds = stored(
        met.filter("differ")
        .groupBy("anchor", "words")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*key, "start", "windows")).alias("copy")),
        "extensions",
    )
    open_anchors = stored(kinds.filter("n = 1").select("anchor").distinct(), "open")
    borders = kinds.join(open_anchors, "anchor", "left_semi").select(
        *[F.col(f"copy.{c}").alias(c) for c in key],
        F.struct("anchor", "copy.start", "copy.windows", (F.col("n") == 1).alias("single")).alias("border"),
    )
    whole_spans = met.filter(~F.col("differ")).select(*key, "start", "windows").unionByName(
        met.filter("differ")
        .join(kinds.filter("n > 1").select("anchor", "words"), ["anchor", "words"], "left_semi")
        .select(*key, "start", "windows")
    )
    infos = stored(
        whole_spans.select(*key, F.struct("start", "windows").alias("span"), F.lit(None).alias("border"))
        .unionByName(borders.select(*key, F.lit(None).alias("span"), "border"))
        .groupBy(*key)
        .agg(F.collect_set("span").alias("spans"), F.collect_set("border").alias("borders")),
        "infos",
    )
    # one pass over the texts; those with borders wait for the comparison of windows
    split = stored(keyed.join(infos, key, "left"), "spans")
    waiting = F.coalesce(F.size("borders"), F.lit(0)) > 0
    out = _cut(split.filter(~waiting).select(row, "text", "spans"), [row])
    bordered = split.filter(waiting)
    one = bordered.dropDuplicates(key).select(*key, "text", "borders")
    windows = stored(_split_windows(one), "windows")
    twice = stored(windows.groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "twice")
    more = (
        windows.filter("single")
        .join(twice, ["anchor", "window"], "left_semi")
        .groupBy(*key)
        .agg(F.collect_list(F.struct("start", F.lit(1).alias("windows"))).alias("more"))
    )
    late = bordered.join(more, key, "left").select(
        row, "text", F.concat("spans", F.coalesce("more", F.array().cast("array<struct<start:int,windows:int>>"))).alias("spans")
    )
    return out.unionByName(_cut(late, [row])).select(f"{row}.*", "n_words", "n_removed", "kept_text")
