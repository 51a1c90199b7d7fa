"""Jaccard join of shingle sets in their metric space.

The distance ``1 - J`` obeys the triangle inequality; documents link within ``e = 1 - t``. Equal
sets are one point, found by a digest. Points are spread over regions and regions are joined:

1. The first pivots are single shingles. A set belongs to the pivot that comes first in a fixed
   order of its shingles (rarest first, by counts over the whole corpus in a table of fixed size).
   A set within ``e`` lacks at most ``|x| - ceil(t |x|)`` of x's shingles, so its own first pivots
   hold one of x's first ``|x| - ceil(t |x|) + 1``: into those regions x is replicated. With a
   window longer by c - 1, linked sets share c pivots; sets that share fewer with any others
   drop out (what a common passage brings together, say), and regions with one point vanish,
   all by counting. (Between two unrelated texts the
   distance is 1 and to every document pivot as well, so windows around document pivots alone
   would replicate everything everywhere; single shingles are the pivots that tell such texts
   apart.)
2. Regions with the same least point are one region with that point as its document pivot, and
   regions that share points are merged where the whole fits a task. While
   a region is too large for a task, all its points measure their distance to the pivot. Points
   within ``e`` link to it and are one component. The others fall into rings of width ``e``; by
   the triangle inequality links join points of one ring or of neighbours, so each ring with a
   window of the ring below it is a region of its own, joined the same way with a new pivot.
3. A region that fits is joined exactly in one task: points outside its largest component are
   measured against all others until none is left. A region that stays too large is cut into
   blocks, and pairs of blocks are joined so.

Each task emits the links that connect its points and not all links among them, so a group of
near copies costs its size and not its square; components are the same. With ``every_link`` a task
measures all pairs of different sets that share a shingle and emits each link; regions too large
for a task are then cut into blocks at once, as a ball around a pivot says nothing of its pairs.

Defined cases: null text and text without words have an empty set, linked with nothing; fewer than
five words make one shingle; equal rows are linked (unless empty); rows with null id take part, and
a component's id is its least non-null one; an empty table gives an empty result; other columns
are handed through if named.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgrid.llm.common import Rolling, Words, free_name, join_small, stored
from tripgrid.llm.components import connected_components

SHINGLE = 5
COUNT_BITS = 20
BLOCK_BITS = 14
TEXTS_AT_ONCE = 200
LEAF_SHINGLES = 2_000_000
LEAF_POINTS = 5_000
LEVELS = 3
BROADCAST_ROWS = 1_000_000
MARGIN = 10  # per cent of a set by which its window is longer than one common pivot needs


def _raw_shingles(words: Words, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts one after another, with repeats, and how many each text has."""
    split = [t.encode().lower().split() if t else [] for t in texts]
    sizes = np.array([len(x) for x in split], np.int64)
    flat = words.hashes([w for x in split for w in x])
    rolling = Rolling(flat)
    first = np.cumsum(sizes) - sizes
    n = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    start = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return rolling.of(start, np.minimum(start + SHINGLE, np.repeat(first + sizes, n))), n


def shingle_sets(words: Words, texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    h, n = _raw_shingles(words, texts)
    return [np.unique(x) for x in np.split(h, np.cumsum(n)[:-1])] if texts else []


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for k in range(0, batch.num_rows, TEXTS_AT_ONCE):
        yield batch.slice(k, TEXTS_AT_ONCE)


def shingle_ranks(docs: DataFrame) -> np.ndarray:
    """Rank of every bucket of shingles: 0 unless it counts clearly more than its share.

    Counts cover all texts; the table has ``1 << COUNT_BITS`` entries whatever their number, and a
    bucket's noise only changes the order of pivots, not a result.
    """
    size = 1 << BLOCK_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = Words(), np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            for part in _slices(batch):
                h, _ = _raw_shingles(words, part.column("text").to_pylist())
                total += np.bincount((h >> np.uint64(64 - COUNT_BITS)).astype(np.int64), minlength=len(total))
        kind = np.uint16 if total.max() < 1 << 16 else np.int64
        blocks = total.astype(kind).reshape(-1, size)
        for b in np.flatnonzero(blocks.any(axis=1)).tolist():
            yield pa.RecordBatch.from_pydict({"block": [b], "wide": [kind is np.int64], "counts": [blocks[b].tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                data = np.frombuffer(row["counts"], np.int64 if row["wide"] else np.uint16).astype(np.int64)
                held[row["block"]] = held[row["block"]] + data if row["block"] in held else data
        for b, total in held.items():
            yield pa.RecordBatch.from_pydict({"block": [b], "counts": [total.tobytes()]})

    sent = docs.select("text").mapInArrow(count, "block long, wide boolean, counts binary")
    blocks = sent.repartition("block").mapInArrow(add, "block long, counts binary")
    total = np.zeros(1 << COUNT_BITS, np.int64)
    for row in blocks.collect():  # as many rows as the table has blocks
        total[row["block"] << BLOCK_BITS : (row["block"] + 1) << BLOCK_BITS] = np.frombuffer(row["counts"], np.int64)
    mean = total.mean()
    over = total - mean
    frequent = over > 3 + 4 * np.sqrt(mean)
    return np.where(frequent, 1 + np.minimum(250, 4 * np.log2(np.maximum(over, 1))), 0).astype(np.uint8)


def _common(n: Column | int) -> Column | int:
    """Pivots that two linked sets share within their windows, if the smaller one has n shingles."""
    return max(1, n * MARGIN // 100) if isinstance(n, int) else F.greatest(F.lit(1), F.floor(n * MARGIN / 100))


def _points(docs: DataFrame, ranks: np.ndarray, percent: int) -> DataFrame:
    """Every row's set: size, digest, its first half as a number, and the first pivots."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    schema = T.StructType(
        [
            docs.schema["row"], T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
            T.StructField("n_shingles", T.LongType()), T.StructField("set_id", T.BinaryType()),
            T.StructField("half", T.LongType()), T.StructField("pivots", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, ranks = Words(), shared.value
        for batch in batches:
            for part in _slices(batch):
                size, ids, halves, windows = [], [], [], []
                for s in shingle_sets(words, part.column("text").to_pylist()):
                    digest = xxhash.xxh3_128_digest(s.tobytes())
                    order = np.argsort(ranks[(s >> np.uint64(64 - COUNT_BITS)).astype(np.int64)], kind="stable")
                    reach = len(s) - -(-len(s) * percent // 100) + _common(len(s)) if len(s) else 0
                    size.append(len(s))
                    ids.append(digest)
                    halves.append(int.from_bytes(digest[:8], "big", signed=True))
                    windows.append(s[order[:reach]].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"), part.column("k1"), part.column("k2"), pa.array(size, pa.int64()),
                        pa.array(ids, pa.binary()), pa.array(halves, pa.int64()), pa.array(windows, pa.list_(pa.int64())),
                    ],
                    names=["row", "k1", "k2", "n_shingles", "set_id", "half", "pivots"],
                )

    return docs.mapInArrow(run, schema)


def _rows(placed: DataFrame, standing: DataFrame, keyed: DataFrame, broadcast_rows: int) -> DataFrame:
    """(region, set_id, n, text) for ``placed`` (region, half).

    Texts travel and not sets: they take about half the room, and sets are quickly made again.
    ``standing`` names the document that stands for each set and how many rows are that document.
    """
    regions = placed.groupBy("half").agg(F.collect_set("region").alias("regions"))
    wanted = stored(
        standing.join(regions, "half").select(
            F.col("k.k1").alias("s1"), F.col("k.k2").alias("s2"), (F.col("k.rows") > 1).alias("again"), "set_id", "n", "regions"
        ),
        "wanted",
    )
    same = (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2"))
    columns = ["set_id", "n", "regions", "text"]
    texts = join_small(keyed, wanted.filter("NOT again"), same, "inner", broadcast_rows).select(*columns)
    again = wanted.filter("again")
    if not again.isEmpty():  # rows alike in every column
        once = join_small(keyed, again, same, "inner", broadcast_rows).dropDuplicates(["k1", "k2"])
        texts = texts.unionByName(once.select(*columns))
    return texts.select(F.explode("regions").alias("region"), "set_id", "n", "text")


def overlap(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted sets."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both, len(x) + len(y) - both


def join_leaf(ids: list[bytes], sets: list[np.ndarray], balls: list[bytes | None], percent: int) -> list[tuple[int, int, float]]:
    """Links (i, j, similarity) that connect all points linked within ``sets``.

    Points with the same ball are known to be connected. Exact: every pair with an end outside the
    largest component has been measured.
    """
    m = len(sets)
    parent = list(range(m))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first: dict[bytes, int] = {}
    for i, ball in enumerate(balls):
        if ball is not None:
            parent[i] = first.setdefault(ball, i)
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), size)
    _, codes, df = np.unique(flat, return_inverse=True, return_counts=True)
    stop = np.cumsum(df)
    holders = owner[np.argsort(codes, kind="stable")]
    at = np.concatenate(([0], np.cumsum(size)))
    done = np.zeros(m, bool)
    links: list[tuple[int, int, float]] = []
    counts: dict[int, int] = {}
    for i in range(m):
        counts[find(i)] = counts.get(find(i), 0) + 1
    waiting = list(range(m - 1, -1, -1))
    while waiting:
        largest = max(counts, key=counts.__getitem__)
        i = waiting.pop()
        if done[i] or counts[largest] == m:
            continue
        if find(i) == largest and any(not done[j] and find(j) != largest for j in waiting):
            waiting.insert(0, i)  # only needed if another component outgrows this one
            continue
        if find(i) == largest:
            break
        done[i] = True
        mine = codes[at[i] : at[i + 1]]
        mine = mine[df[mine] > 1]
        spans = df[mine]
        if not len(spans):
            continue
        where = np.repeat(stop[mine] - df[mine] - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
        both = np.bincount(holders[where], minlength=m)
        union = size[i] + size - both
        for j in np.flatnonzero(100 * both >= percent * union).tolist():
            a, b = find(i), find(j)
            if a != b:
                parent[a] = b
                counts[b] += counts.pop(a)
                links.append((i, j, both[j] / union[j]))
    return links


def every_pair(sets: list[np.ndarray], percent: int) -> list[tuple[int, int, float]]:
    """All links (i, j, similarity), i < j; each set is counted against those that share a shingle."""
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, codes, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    stop = np.cumsum(df)
    holders = owner[np.argsort(codes, kind="stable")]
    at = np.concatenate(([0], np.cumsum(size)))
    links = []
    for i in range(len(sets)):
        mine = codes[at[i] : at[i + 1]]
        spans = df[mine]
        where = np.repeat(stop[mine] - spans - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
        both = np.bincount(holders[where], minlength=len(sets))
        union = size[i] + size - both
        found = np.flatnonzero(100 * both >= percent * union)
        links += [(i, j, both[j] / union[j]) for j in found[found > i].tolist()]
    return links


def _leaves(rows: DataFrame, percent: int, every_link: bool = False) -> DataFrame:
    """Links of all regions (region, left, right), each joined in one task: (a, b, similarity, root)."""

    words = Words()

    def join(group: list[tuple]) -> Iterator[pa.RecordBatch]:
        ids = [g[0] for g in group]
        sets = [x for k in range(0, len(group), TEXTS_AT_ONCE) for x in shingle_sets(words, [g[1] for g in group[k : k + TEXTS_AT_ONCE]])]
        links = every_pair(sets, percent) if every_link else join_leaf(ids, sets, [g[2] for g in group], percent)
        if links:
            parent = list(range(len(ids)))

            def find(i: int) -> int:
                while parent[i] != i:
                    i = parent[i]
                return i

            for i, j, _ in links:
                a, b = sorted((find(i), find(j)), key=lambda k: ids[k])
                if a != b:
                    parent[b] = a
            yield pa.RecordBatch.from_pydict(
                {
                    "a": pa.array([ids[i] for i, _, _ in links], pa.binary()),
                    "b": pa.array([ids[j] for _, j, _ in links], pa.binary()),
                    "similarity": pa.array([s for _, _, s in links], pa.float64()),
                    "root": pa.array([ids[find(i)] for i, _, _ in links], pa.binary()),
                }
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("region", "left", "right", "set_id", "text", "ball")]
            for region, left, right, set_id, text, ball in zip(*columns, strict=True):
                if (region, left, right) != key:
                    if len(group) > 1:
                        yield from join(group)
                    key, group = (region, left, right), []
                group.append((set_id, text, ball))
        if len(group) > 1:
            yield from join(group)

    keys = ["region", "left", "right"]
    placed = rows.repartition(*keys).sortWithinPartitions(*keys, "set_id")
    return placed.select(*keys, "set_id", "text", "ball").mapInArrow(
        run, "a binary, b binary, similarity double, root binary"
    )


def _measure(rows: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """One level of pivots for regions too large: links to pivots, and the rows of the rings."""
    e = (100 - percent) / 100
    rows = stored(rows, "large-regions")
    # the pivot is the least point that is not yet in a ball, or the least of all
    chosen = rows.groupBy("region").agg(
        F.coalesce(F.min(F.when(F.col("ball").isNull(), F.col("set_id"))), F.min("set_id")).alias("pivot")
    )
    pivots = stored(
        rows.select("region", F.col("set_id").alias("pivot"), F.col("text").alias("theirs")).join(
            stored(chosen, "chosen"), ["region", "pivot"]
        ),
        "region-pivots",
    )
    both = rows.join(pivots, "region")

    @F.pandas_udf("same long, all long")
    def compare(ours: pd.Series, theirs: pd.Series) -> pd.DataFrame:
        words, pivot, held, out = Words(), None, None, []
        for a, b in zip(ours, theirs, strict=True):
            if b != pivot:
                pivot, held = b, shingle_sets(words, [b])[0]
            out.append(overlap(shingle_sets(words, [a])[0], held))
        return pd.DataFrame(out, columns=["same", "all"])

    seen = stored(both.withColumn("o", compare("text", "theirs")).drop("theirs"), "measured")
    near = 100 * F.col("o.same") >= percent * F.col("o.all")
    links = seen.filter(near & (F.col("set_id") != F.col("pivot"))).select(
        F.col("set_id").alias("a"), F.col("pivot").alias("b"),
        (F.col("o.same") / F.col("o.all")).alias("similarity"), F.col("pivot").alias("root"),
    )
    far = (1 - F.col("o.same") / F.col("o.all")) / e
    ring = F.floor(far).cast("int")
    # a point lies in its ring's region and in the window of the next ring (and of the one after, on the edge)
    placed = seen.select(
        "region", "set_id", "n", "text", F.when(near, F.col("pivot")).otherwise(F.col("ball")).alias("ball"),
        (~near & (ring >= 1)).alias("home"),
        F.explode(F.sequence(F.greatest(F.lit(1), ring), F.floor(far + 1 + 1e-6).cast("int"))).alias("ring"),
    )
    homes = stored(placed.filter(F.col("home")).select("region", "ring").distinct(), "homes")
    inner = placed.join(homes, ["region", "ring"], "left_semi")
    return links, inner.select(F.xxhash64("region", "ring").alias("region"), "set_id", "n", "text", "ball")


def _sizes(members: DataFrame, leaf_shingles: int, leaf_points: int) -> DataFrame:
    """(region, points, blocks): how many tasks' worth of points and shingles a region holds."""
    blocks = F.greatest(F.ceil(F.col("total") / leaf_shingles), F.ceil(F.col("points") / leaf_points))
    sizes = members.groupBy("region").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("points"))
    return stored(sizes.select("region", "points", blocks.cast("int").alias("blocks")), "region-sizes")


def _merged(members: DataFrame, leaf_shingles: int, leaf_points: int) -> DataFrame:
    """Regions that share points made one, wherever the whole fits a task.

    A point of many small regions is then in one. Where the whole does not fit, regions stay.
    """
    labels = connected_components(members.select(F.col("half").alias("a"), F.col("region").alias("b")))
    whole = labels.select(F.col("node").alias("half"), F.col("label").alias("whole"))
    placed = stored(members.join(whole, "half"), "placed")
    points = placed.select(F.col("whole").alias("region"), "half", "n").distinct()
    fits = _sizes(points, leaf_shingles, leaf_points).filter("blocks = 1").select(F.col("region").alias("whole"))
    return stored(
        points.join(fits.withColumnRenamed("whole", "region"), "region", "left_semi").unionByName(
            placed.join(fits, "whole", "left_anti").select("region", "half", "n")
        ),
        "merged",
    )


def _region_links(
    members: DataFrame, rows_of: Callable[[DataFrame], DataFrame], percent: int,
    leaf_shingles: int, leaf_points: int, levels: int, every_link: bool = False,
) -> DataFrame:
    """Links of all regions; ``members`` are (region, half, n), a point in several regions."""
    zero = F.lit(0)
    one_task, none = {"left": zero, "right": zero}, F.lit(None).cast("binary")
    sizes = _sizes(members, leaf_shingles, leaf_points)
    fits = members.join(sizes.filter("blocks = 1 AND points > 1"), "region", "left_semi")
    parts = [_leaves(rows_of(fits.select("region", "half")).withColumns({**one_task, "ball": none}), percent, every_link)]
    level, rows = levels if every_link else 0, None
    while not (hot := sizes.filter("blocks > 1").select("region", "blocks")).isEmpty():
        if rows is None:
            large = members.select("region", "half").join(hot, "region", "left_semi")
            rows = rows_of(large).withColumn("ball", none)
        large = rows.join(hot, "region")
        if level == levels:
            block = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
            other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
            pairs = large.withColumn("block", block).withColumn("other", other)
            parts.append(
                _leaves(pairs.withColumns({"left": F.least("block", "other"), "right": F.greatest("block", "other")}), percent, every_link)
            )
            break
        links, inner = _measure(large.select("region", "set_id", "n", "text", "ball"), percent)
        parts.append(links)
        rows, level = stored(inner, "rings"), level + 1
        sizes = _sizes(rows, leaf_shingles, leaf_points)
        small = rows.join(sizes.filter("blocks = 1 AND points > 1"), "region", "left_semi")
        parts.append(_leaves(small.withColumns(one_task), percent))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _keys(row: Column) -> dict[str, Column]:
    return {"k1": F.xxhash64(row, "text"), "k2": F.xxhash64("text", F.lit(1))}


def near_duplicates(
    docs: DataFrame,
    keep: list[str],
    percent: int = 80,
    leaf_shingles: int = LEAF_SHINGLES,
    leaf_points: int = LEAF_POINTS,
    levels: int = LEVELS,
    broadcast_rows: int = BROADCAST_ROWS,
    every_link: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Memberships and links.

    Memberships: one row per document with ``row`` (struct of ``keep``), ``k1`` and ``k2`` (hashes
    of row and text), ``n_shingles``, ``set_id`` and ``label`` (equal for connected documents).
    Links: (a, b, similarity) between set ids, enough to connect every component; with
    ``every_link`` each link between different sets, once, ``a`` being the smaller id.
    """
    whole = docs.select(F.struct(*keep).alias("row"), "text")
    keyed = whole.withColumns(_keys(F.col("row")))
    points = stored(_points(keyed, shingle_ranks(whole), percent), "points")

    # one row of every set takes part; rows alike in every column may remain, and only cost
    reps = stored(
        points.filter("n_shingles > 0").groupBy("set_id").agg(F.min(F.struct("k1", "k2")).alias("k")).select("k.*"), "reps"
    ).withColumnsRenamed({"k1": "s1", "k2": "s2"})
    same = (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2"))
    apart = join_small(points, reps, same, "left_semi", broadcast_rows)
    held = apart.select("half", F.explode("pivots").alias("pivot"))
    shared = stored(held.groupBy("pivot").count().filter("count > 1").select("pivot"), "pivots")
    met = stored(held.join(shared, "pivot", "left_semi"), "met")
    # a set with a partner shares this many pivots; those that share fewer (a common passage, say) have none
    sizes = apart.select("half", F.col("n_shingles").alias("n"))
    enough = _common(F.ceil(F.col("n") * percent / 100))
    near = met.groupBy("half").count().join(sizes, "half").filter(F.col("count") >= enough)
    near = stored(near.select(F.col("half").alias("near")).distinct(), "near")
    met = join_small(met, near, F.col("half") == F.col("near"), "left_semi", broadcast_rows)
    regions = met.groupBy(F.col("pivot").alias("p")).agg(F.min("half").alias("region"), F.max("half").alias("other"))
    regions = stored(regions.filter("region != other").select("p", "region"), "regions")
    members = join_small(met, regions, F.col("pivot") == F.col("p"), "inner", broadcast_rows)
    members = stored(members.select("region", "half").distinct(), "members")
    # one document stands for every set that lies in a region
    found = points.join(stored(members.select("half").distinct(), "halves"), "half", "left_semi")
    alike = found.groupBy("set_id", "half", F.col("n_shingles").alias("n"), "k1", "k2").agg(F.count(F.lit(1)).alias("rows"))
    standing = stored(
        alike.groupBy("set_id", "half", "n").agg(F.min(F.struct("k1", "k2", "rows")).alias("k")), "standing"
    )
    weighed = members.join(standing.groupBy("half").agg(F.sum("n").alias("n")), "half")
    merged = _merged(weighed, leaf_shingles, leaf_points)

    def rows_of(placed: DataFrame) -> DataFrame:
        return _rows(placed, standing, keyed, broadcast_rows)

    links = stored(_region_links(merged, rows_of, percent, leaf_shingles, leaf_points, levels, every_link), "links")
    if every_link:  # blocks and regions that share points find some links again
        links = stored(links.groupBy("a", "b").agg(F.first("similarity").alias("similarity"), F.min("root").alias("root")), "every-link")
    stars = links.select("a", F.col("root").alias("b")).unionByName(links.select(F.col("b").alias("a"), F.col("root").alias("b")))
    labels = connected_components(stars)
    named = join_small(points.drop("pivots", "half"), labels, F.col("set_id") == F.col("node"), "left", broadcast_rows)
    return (
        named.select("row", "k1", "k2", "n_shingles", "set_id", F.coalesce("label", "set_id").alias("label")),
        links.select("a", "b", "similarity"),
    )


def link_counts(docs: DataFrame, keep: list[str], **options) -> DataFrame:
    """``keep``, n_shingles and n_links: to how many different other sets each document's set is linked."""
    members, links = near_duplicates(docs, keep, every_link=True, **options)
    ends = links.select(F.explode(F.array("a", "b")).alias("of"))
    counts = stored(ends.groupBy("of").agg(F.count(F.lit(1)).alias("n_links")), "link-counts")
    joined = join_small(members, counts, F.col("set_id") == F.col("of"), "left", options.get("broadcast_rows", BROADCAST_ROWS))
    return joined.select("row.*", "n_shingles", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def components(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles and component_id (least doc_id reachable by links) for every document."""
    members, _ = near_duplicates(docs, ["doc_id"], **options)
    members = members.select("row.doc_id", "n_shingles", "label")
    least = members.filter("n_shingles > 0").groupBy(F.col("label").alias("of")).agg(F.min("doc_id").alias("least"))
    # written first, so that adaptive execution can split a component that holds a large share of all
    members, least = stored(members, "memberships"), stored(least, "components")
    joined = members.join(least, F.col("label") == F.col("of"), "left")
    own = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", own.alias("component_id"))


def drop_near_duplicates(docs: DataFrame, broadcast_rows: int = BROADCAST_ROWS, **options) -> DataFrame:
    """``docs`` with one row of every component: that of the least doc_id, null before all others.

    Rows without words stay. Of equal rows one stays.
    """
    whole = free_name(docs.columns, "whole")
    hashed = docs.withColumn(whole, F.xxhash64(*docs.columns))
    members, _ = near_duplicates(hashed, ["doc_id", whole], broadcast_rows=broadcast_rows, **options)
    linked = stored(members.filter("n_shingles > 0").select("row.doc_id", "k1", "k2", "label"), "members")
    first = stored(linked.groupBy("label").agg(F.min(F.struct("doc_id", "k1", "k2")).alias("first")), "first")
    judged = linked.join(first, "label")
    stays = (F.col("k1") == F.col("first.k1")) & (F.col("k2") == F.col("first.k2"))
    mark = {"k1": "j1", "k2": "j2"}
    leaving = stored(judged.filter(~stays).select("k1", "k2").distinct(), "leaving").withColumnsRenamed(mark)
    copies = stored(judged.filter(stays).groupBy("k1", "k2").count().filter("count > 1"), "copies").withColumnsRenamed(mark)
    rows = hashed.select(F.struct(*docs.columns).alias("all"), F.struct("doc_id", whole).alias("row"), "text")
    keyed = rows.withColumns(_keys(F.col("row")))
    same = (F.col("k1") == F.col("j1")) & (F.col("k2") == F.col("j2"))
    rest = join_small(keyed, leaving, same, "left_anti", broadcast_rows)
    if copies.isEmpty():
        return rest.select("all.*")
    marked = join_small(rest, copies, same, "left", broadcast_rows)
    once = marked.filter("count IS NOT NULL").dropDuplicates(["k1", "k2"])
    return marked.filter("count IS NULL").unionByName(once).select("all.*")
