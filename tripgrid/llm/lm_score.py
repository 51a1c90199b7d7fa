"""Documents scored by the cross-entropy difference of two word bigram models.

The target model counts the labelled good documents, the background model all the others. Every
word and every pair of neighbours of the corpus has a count of its own, told apart by 64-bit
hashes; the counts are whole numbers. A document's own counts are taken out of the model it was
counted into before its loss is formed.

Documents are dealt into blocks of about ``BLOCK_CHARS`` characters. A block sends each distinct
word and pair once, with its counts, to the range of hashes it falls in; the range adds them up and
sends the totals back to the blocks that asked. A hot word costs one row per block. A range is added
up in one worker, which holds a row of nearly every block, and there are rows for each block and
range: they grow as the square of the text until a range holds about one key of a block. ``word_bits`` and ``pair_bits`` below 64 share counts
between words whose first bits agree.

Per token the loss is ``-log p`` with ``p = (c(v,w) + s q(w)) / (c(v) + s)`` and
``q(w) = (c(w) + 1/2) / (N + V/2)``, where ``V`` is the number of distinct words of both sides (with
fewer bits, of buckets); the score is the mean of target loss minus background loss, low for
documents like the target.

Defined cases: null or empty text has no tokens and null losses; documents without a label, or
with null id, belong to the background; repeated rows count as often as they occur; repeated
labels count once, and one good label is enough; an empty side gives its uniform model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgrid.llm.common import Words, join_small, stored

DOCS_AT_ONCE = 500
#: characters of a block of documents, and of the text behind one range of hashes
BLOCK_CHARS = 12_000_000
RANGE_CHARS = 24_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def buckets(words: Words, texts: list[str | None], word_bits: int, pair_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, neighbour buckets and tokens per text, all texts one after another.

    A text's first word has the neighbour bucket of a pair with a start mark.
    """
    h = [words.hashes(t.encode().split() if t else []) for t in texts]
    sizes = np.array([len(x) for x in h], np.int64)
    flat = np.concatenate([np.empty(0, np.uint64), *h])
    before = np.empty_like(flat)
    before[1:] = flat[:-1]
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = 1
    mixed = (before * MIX ^ (before >> np.uint64(31))) + flat
    mixed *= MIX
    word = ((flat * MIX) >> np.uint64(64 - word_bits)).astype(np.int64)
    pair = (mixed >> np.uint64(64 - pair_bits)).astype(np.int64)
    return word, pair, sizes


def _shrunk(counts: np.ndarray) -> bytes:
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if counts.max(initial=0) <= np.iinfo(k).max)
    return kind.encode() + counts.astype(kind).tobytes()


def _grown(data: bytes) -> np.ndarray:
    return np.frombuffer(data[3:], data[:3].decode()).astype(np.int64)


def _packed(keys: np.ndarray) -> bytes:
    """Ascending distinct keys, as the first one and the steps between them in as few bytes as the widest needs."""
    steps = np.diff(keys)
    width = max(1, -(-int(steps.max(initial=0)).bit_length() // 8))
    return bytes([width]) + keys[:1].tobytes() + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    raw = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(raw), 8), np.uint8)
    steps[:, :width] = raw
    return np.cumsum(np.concatenate((np.frombuffer(data, "<u8", 1, 1), steps.view("<u8").ravel())), dtype=np.uint64)


def _hashed(words: Words, texts: list[str | None], word_bits: int, pair_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``buckets`` of all texts, as keys spread over all of 64 bits."""
    parts = [buckets(words, texts[k : k + DOCS_AT_ONCE], word_bits, pair_bits) for k in range(0, len(texts), DOCS_AT_ONCE)]
    word, pair, sizes = (np.concatenate([np.empty(0, np.int64), *x]) for x in (zip(*parts, strict=True) if parts else ([], [], [])))
    return word.astype(np.uint64) << np.uint64(64 - word_bits), pair.astype(np.uint64) << np.uint64(64 - pair_bits), sizes


def in_blocks(docs: DataFrame) -> DataFrame:
    """``docs`` with a number ``block`` that consecutive documents of a task share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, used = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            total = used + np.cumsum(sizes.astype(np.int64))
            block = pa.array(first + total // BLOCK_CHARS)
            used = int(total[-1]) if len(total) else used
            yield pa.RecordBatch.from_arrays([*batch.columns, block], names=[*batch.schema.names, "block"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("block", T.LongType())]))


SENT = "range long, kind int, block long, keys binary, background binary, target binary"
TOTALS = "range long, kind int, block long, n long, background binary, target binary, all_background long, all_target long"


def sent(docs: DataFrame, ranges: int, word_bits: int, pair_bits: int) -> DataFrame:
    """Distinct words (kind 0) and pairs (kind 1) of each block and range of hashes, with counts of both sides."""

    def rows(block: int, keys: tuple[np.ndarray, np.ndarray], side: np.ndarray) -> Iterator[pa.RecordBatch]:
        for kind, key in enumerate(keys):
            known, at = np.unique(key, return_inverse=True)
            n = [np.bincount(at[side == s], minlength=len(known)) for s in (0, 1)]
            cuts = np.searchsorted(_range(known, ranges), np.arange(ranges + 1))
            filled = np.flatnonzero(np.diff(cuts))
            parts = [slice(cuts[r], cuts[r + 1]) for r in filled]
            yield pa.RecordBatch.from_pydict(
                {
                    "range": pa.array(filled), "kind": pa.array([kind] * len(parts), pa.int32()), "block": pa.array([block] * len(parts), pa.int64()),
                    "keys": pa.array([_packed(known[x]) for x in parts], pa.binary()),
                    **{c: pa.array([_shrunk(n[s][x]) for x in parts], pa.binary()) for s, c in enumerate(("background", "target"))},
                }
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, block, parts = Words(), None, []
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            for part in np.split(np.arange(len(blocks)), np.flatnonzero(np.diff(blocks)) + 1):
                if not len(part):
                    continue
                if parts and blocks[part[0]] != block:
                    yield from rows(block, *_joined(parts))
                    parts = []
                block = int(blocks[part[0]])
                for k in range(int(part[0]), int(part[-1]) + 1, DOCS_AT_ONCE):
                    few = batch.slice(k, min(DOCS_AT_ONCE, int(part[-1]) + 1 - k))
                    word, pair, sizes = _hashed(words, few.column("text").to_pylist(), word_bits, pair_bits)
                    parts.append((word, pair, np.repeat(few.column("target").to_numpy(zero_copy_only=False).astype(np.int64), sizes)))
        if parts:
            yield from rows(block, *_joined(parts))

    return docs.select("block", "text", "target").mapInArrow(run, SENT)


def _joined(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    word, pair, side = (np.concatenate(x) for x in zip(*parts, strict=True))
    return (word, pair), side


def _range(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Ascending numbers of ranges of ascending keys."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def totals(counted: DataFrame) -> DataFrame:
    """Counts of all documents for what each block sent, in ascending order of its keys.

    One more row per range and kind, without a block, has the number of its keys and the sums of their counts.
    """

    def add(table: pa.Table) -> pa.Table:
        r, kind = table.column("range")[0].as_py(), table.column("kind")[0].as_py()
        keys: dict[int, list[np.ndarray]] = {}
        counts: list[tuple[np.ndarray, np.ndarray]] = []
        order: list[np.ndarray] = []
        for block, k, b, t in zip(*(table.column(c).to_pylist() for c in ("block", "keys", "background", "target")), strict=True):
            keys.setdefault(block, []).append(_unpacked(k))
            order.append(keys[block][-1])
            counts.append((_grown(b), _grown(t)))
        known, at = np.unique(np.concatenate(order), return_inverse=True)
        both = [np.zeros(len(known), np.int64) for _ in range(2)]
        stop = np.cumsum([len(x) for x in order])
        for a, b, pair in zip([0, *stop[:-1]], stop, counts, strict=True):
            for total, n in zip(both, pair, strict=True):
                total[at[a:b]] += n  # keys of one row are distinct
        out = [(r, kind, None, len(known), None, None, int(both[0].sum()), int(both[1].sum()))]
        for block, parts in keys.items():
            # a block that was read in two parts asks for all of its keys at once
            asked = np.searchsorted(known, parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts)))
            out.append((r, kind, block, len(asked), _shrunk(both[0][asked]), _shrunk(both[1][asked]), None, None))
        columns = zip(*out, strict=True)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
        names = [x.split()[0] for x in TOTALS.split(", ")]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return counted.groupBy("range", "kind").applyInArrow(add, TOTALS)


def losses(
    keys: tuple[np.ndarray, np.ndarray], counts: tuple[np.ndarray, np.ndarray], sizes: np.ndarray, target: np.ndarray,
    total: list[int], vocabulary: float, weight: float,
) -> np.ndarray:
    """Mean loss of each text (background, target); its own counts are left out of its side.

    ``counts`` has the counts of both sides for the distinct words and pairs, in ascending order.
    """
    out = np.full((2, len(sizes)), np.nan)
    if not len(keys[0]):
        return out
    (words, word), (pairs, pair) = (np.unique(k, return_inverse=True) for k in keys)
    if (len(words), len(pairs)) != (counts[0].shape[1], counts[1].shape[1]):
        raise ValueError("a block's counts do not fit its words")
    text = np.repeat(np.arange(len(sizes)), sizes)
    start = (np.cumsum(sizes) - sizes)[sizes > 0]
    own_w, own_p = _own(text, word), _own(text, pair)
    own_v, before, own_n = np.roll(own_w, 1), np.roll(word, 1), np.repeat(sizes, sizes)
    for side in (0, 1):
        mine = np.repeat(target == side, sizes)
        c_w = counts[0][side][word] - mine * own_w
        c_p = counts[1][side][pair] - mine * own_p
        c_v = counts[0][side][before] - mine * own_v
        q = (c_w + 0.5) / (total[side] - mine * own_n + 0.5 * vocabulary)
        c_v[start], c_p[start] = 0, 0  # a first word has no neighbour in front
        p = (c_p + weight * q) / (np.maximum(c_v, c_p) + weight)
        out[side][sizes > 0] = np.add.reduceat(-np.log(p), start) / sizes[sizes > 0]
    return out


def _own(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each token, how often its word or pair occurs in its text."""
    _, inverse, n = np.unique((text << 32) | at, return_inverse=True, return_counts=True)
    return n[inverse]


def score(
    docs: DataFrame,
    labels: DataFrame,
    keep: list[str],
    word_bits: int = 64,
    pair_bits: int = 64,
    weight: float = 4.0,
    broadcast_labels: int = 2_000_000,
) -> DataFrame:
    """``keep``, n_tokens, loss_target, loss_background and their difference ``score``.

    ``docs`` has doc_id and text, ``labels`` doc_id and quality (1 is good).
    """
    good = labels.filter(F.col("quality") == 1).select(F.col("doc_id").alias("_good")).distinct()
    whole = docs.select(F.struct(*keep).alias("row"), "text", F.col("doc_id").alias("_id"))
    marked = join_small(whole, good, F.col("_id") == F.col("_good"), "left", broadcast_labels)
    # written once, so that a block holds the same documents whenever it is read
    blocks = stored(in_blocks(marked.select("row", "text", F.col("_good").isNotNull().alias("target"))), "lm-blocks")
    chars = blocks.agg(F.sum(F.length("text"))).first()[0] or 0
    counted = stored(totals(sent(blocks, -(-chars // RANGE_CHARS) or 1, word_bits, pair_bits)), "lm-counts")
    sums = counted.filter("block is null and kind = 0").agg(F.sum("n"), F.sum("all_background"), F.sum("all_target")).first()
    n_words, *total = (x or 0 for x in sums)
    vocabulary = float(n_words if word_bits == 64 else 1 << word_bits)
    fields = [blocks.schema["row"], T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField(c, T.DoubleType()) for c in ("loss_background", "loss_target")]

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        keys_w, keys_p, sizes = _hashed(Words(), docs.column("text").to_pylist(), word_bits, pair_bits)
        known = known.sort_by([("kind", "ascending"), ("range", "ascending")])
        counts = []
        for kind in (0, 1):
            part = known.filter(pa.compute.equal(known.column("kind"), kind))
            sides = [[_grown(x) for x in part.column(c).to_pylist()] for c in ("background", "target")]
            counts.append(np.stack([np.concatenate([np.empty(0, np.int64), *x]) for x in sides]))
        target = docs.column("target").to_numpy().astype(np.int64)
        loss = losses((keys_w, keys_p), tuple(counts), sizes, target, total, vocabulary, weight)
        names = ["row", "n_tokens", "loss_background", "loss_target"]
        return pa.Table.from_arrays([docs.column("row"), pa.array(sizes), pa.array(loss[0]), pa.array(loss[1])], names=names)

    asked = counted.filter("block is not null").select("block", "range", "kind", "background", "target")
    scored = blocks.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(run, T.StructType(fields))
    found = [F.when(F.col("n_tokens") > 0, F.col(c)).alias(c) for c in ("loss_target", "loss_background")]
    return scored.select("row.*", "n_tokens", *found).withColumn("score", F.col("loss_target") - F.col("loss_background"))
