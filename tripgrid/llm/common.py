"""Small helpers the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tripgrid.session import scratch_dir

# white space of the word rule: space and the five control characters 0x09-0x0D
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor can read, so a lost executor costs a retry of the
    reading task only.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than that many and one."""
    return df.limit(rows + 1).count() <= rows


def join_small(left: DataFrame, right: DataFrame, on: Column, how: str, rows: int) -> DataFrame:
    """Join with ``right`` broadcast only if it is counted to have at most ``rows`` rows.

    Beyond that bound the join shuffles both sides, and adaptive execution splits hot keys.
    """
    return left.join(F.broadcast(right) if small_enough(right, rows) else right, on, how)


def free_name(taken: Sequence[str], name: str) -> str:
    """``name``, with underscores in front until no column of ``taken`` has it (case ignored)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def append_column(
    df: DataFrame, source: str, name: str, kind: T.DataType, compute: Callable[[], Callable[[list], list]], rows: int = 200
) -> DataFrame:
    """``df`` with the column ``name``, computed from ``source`` in Python.

    ``compute`` is called once per task and gives the function from values to values. Values leave
    in slices of ``rows`` rows, so a task never holds the results of a whole Arrow batch.
    """

    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = compute()
        for batch in batches:
            for k in range(0, batch.num_rows, rows):
                part = batch.slice(k, rows)
                new = pa.array(apply(part.column(source).to_pylist()), arrow)
                yield pa.RecordBatch.from_arrays([*part.columns, new], names=[*part.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, kind)]))


class Words:
    """Hashes of words, remembered up to a bounded number."""

    KEPT = 400_000

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def hashes(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > self.KEPT:
            self.known = {}
        get, learn = self.known.get, self.known.setdefault
        return np.fromiter((get(w) or learn(w, xxhash.xxh64_intdigest(w)) for w in words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads all bits of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Rolling:
    """Hashes of any stretch of a sequence of word hashes, from prefix sums."""

    BASE = np.uint64(0x9E3779B97F4A7C15)
    INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

    def __init__(self, h: np.ndarray) -> None:
        power = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(len(h), self.BASE))))
        self.back = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(len(h), self.INVERSE))))
        self.sums = np.concatenate(([np.uint64(0)], np.add.accumulate(h * power[: len(h)], dtype=np.uint64)))

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.back[start] + (stop - start).astype(np.uint64))
