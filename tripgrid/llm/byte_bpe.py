"""Byte-level BPE encoding and decoding with given ranks.

A text is cut by the pattern; each distinct piece of a batch is a row of bytes. Rows of similar
length form a padded matrix of token ids. In every round each row merges its leftmost pair of
minimum rank: pair ids come from a hash table held in numpy arrays, the row is shifted left over
the freed cell, the two touched pairs are looked up again, and finished rows leave the matrix.
Pieces too long for a matrix are folded: one row in blocks, with a minimum for each block, so a
round costs about the root of the length; the order of merges is the same.

Results of distinct pieces are kept between batches of a task, up to a bounded number of ids.

Defined cases: null text encodes as empty, null ids decode to empty bytes; ids unknown to the
vocabulary raise; repeated rows give repeated results; other columns are handed through.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgrid.llm.common import append_column

NONE = np.int32(2**31 - 1)
LONGEST_ROW = 1024
BLOCK = 1024
KEPT_PIECES = 200_000
CHARS_AT_ONCE = 500_000


class PairTable:
    """Open-addressing hash table (left id, right id) -> merged id, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        self.probes = 0
        left, at = np.arange(len(keys)), self.slot(keys)
        while len(left):
            self.probes += 1
            free = left[self.keys[at] == -1]
            where = at[self.keys[at] == -1]
            self.keys[where] = keys[free]  # of several rows for one cell the last one stays
            self.values[where] = values[free]
            out = self.keys[at] != keys[left]
            left, at = left[out], (at[out] + 1) & ((1 << self.bits) - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at = self.slot(keys)
        out = np.where(self.keys[at] == keys, self.values[at], NONE)
        open_ = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] != -1))
        at = at[open_]
        for _ in range(1, self.probes):
            if not len(open_):
                break
            at = (at + 1) & ((1 << self.bits) - 1)
            hit = self.keys[at] == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            more = ~hit & (self.keys[at] != -1)
            open_, at = open_[more], at[more]
        return out


class ByteBpe:
    """Encoder and decoder for ranks in the ``.tiktoken`` format; a token's id is its rank."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes = {i: t for t, i in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.single = np.full(256, -1, np.int32)
        for b in range(256):
            self.single[b] = self.ranks[bytes([b])]
        pairs = [
            (self.ranks[t[:k]] << 32 | self.ranks[t[k:]], i)
            for t, i in self.ranks.items()
            for k in range(1, len(t))
            if t[:k] in self.ranks and t[k:] in self.ranks
        ]
        self.pairs = PairTable(np.array([k for k, _ in pairs], np.int64), np.array([v for _, v in pairs], np.int32))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.empty(1 << 16, np.int32)
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.used = 0

    # -- merging ---------------------------------------------------------------------------

    def _merge_matrix(self, rows: list[bytes], width: int) -> list[np.ndarray]:
        """Token ids of each row; all rows have at most ``width`` bytes."""
        n = np.array([len(r) for r in rows])
        raw = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(len(rows), width)
        tokens = self.single[raw]
        rank = self.pairs.get(tokens[:, :-1].ravel(), tokens[:, 1:].ravel()).reshape(len(rows), width - 1)
        rank[np.arange(width - 1) >= (n - 1)[:, None]] = NONE
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(rows)
        ids = np.arange(len(rows))
        columns = np.arange(width)
        while len(ids):
            at = rank.argmin(axis=1)
            row = np.arange(len(ids))
            best = rank[row, at]
            done = best == NONE
            if done.any():
                for i in np.flatnonzero(done):
                    out[ids[i]] = tokens[i, : n[i]].copy()
                stay = ~done
                tokens, rank, n, ids, at, best = tokens[stay], rank[stay], n[stay], ids[stay], at[stay], best[stay]
                row = row[: len(ids)]
                if not len(ids):
                    break
                width = int(n.max())  # compaction: columns that no row uses any more go as well
                tokens, rank, columns = tokens[:, :width], rank[:, : max(1, width - 1)], columns[:width]
            tokens[row, at] = best
            beyond = columns[1:-1] > at[:, None]
            tokens[:, 1:-1] = np.where(beyond, tokens[:, 2:], tokens[:, 1:-1])
            if rank.shape[1] > 1:
                shifted = columns[: rank.shape[1] - 1] > at[:, None]
                rank[:, :-1] = np.where(shifted, rank[:, 1:], rank[:, :-1])
            n = n - 1
            rank[row, np.minimum(n - 1, rank.shape[1] - 1)] = NONE
            for side in (at - 1, at):
                fit = np.flatnonzero((side >= 0) & (side < n - 1))
                rank[fit, side[fit]] = self.pairs.get(tokens[fit, side[fit]], tokens[fit, side[fit] + 1])
        return out

    def _merge_folded(self, piece: bytes) -> np.ndarray:
        """The same merges for one long row, folded into blocks."""
        size = len(piece)
        tokens = self.single[np.frombuffer(piece, np.uint8)].copy()
        rank = np.full(-(-size // BLOCK) * BLOCK, NONE, np.int32)
        rank[: size - 1] = self.pairs.get(tokens[:-1], tokens[1:])
        folded = rank.reshape(-1, BLOCK)
        least = folded.min(axis=1)
        after = np.arange(1, size + 1)
        before = np.arange(-1, size - 1)
        while True:
            block = int(least.argmin())
            if least[block] == NONE:
                break
            i = block * BLOCK + int(folded[block].argmin())
            j = int(after[i])
            tokens[i], rank[j] = rank[i], NONE
            after[i] = k = int(after[j])
            tokens[j] = -1
            touched = {j // BLOCK, block}
            if k < size:
                before[k] = i
                rank[i] = self.pairs.get(tokens[i : i + 1], tokens[k : k + 1])[0]
            else:
                rank[i] = NONE
            h = int(before[i])
            if h >= 0:
                rank[h] = self.pairs.get(tokens[h : h + 1], tokens[i : i + 1])[0]
                touched.add(h // BLOCK)
            for b in touched:
                least[b] = folded[b].min()
        return tokens[tokens >= 0]

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece, by buckets of lengths up to powers of two."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if (whole := self.ranks.get(p)) is not None:
                out[i] = np.array([whole], np.int32)
            elif len(p) > LONGEST_ROW:
                out[i] = self._merge_folded(p)
            else:
                buckets.setdefault(max(2, 1 << (len(p) - 1).bit_length()), []).append(i)
        for width, rows in buckets.items():
            step = max(64, (1 << 18) // width)
            for k in range(0, len(rows), step):
                part = rows[k : k + step]
                for i, ids in zip(part, self._merge_matrix([pieces[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    # -- texts -----------------------------------------------------------------------------

    def _learn(self, new: list[str]) -> None:
        found = self.merge([p.encode() for p in new])
        sizes = np.array([len(x) for x in found])
        first = len(self.known)
        while first + len(new) > len(self.start):
            self.start, self.length = np.resize(self.start, 2 * len(self.start)), np.resize(self.length, 2 * len(self.length))
        while self.used + sizes.sum() > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.start[first : first + len(new)] = self.used + np.cumsum(sizes) - sizes
        self.length[first : first + len(new)] = sizes
        self.flat[self.used : self.used + sizes.sum()] = np.concatenate(found)
        self.used += int(sizes.sum())
        self.known.update(zip(new, range(first, first + len(new)), strict=True))

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        pieces: list[str] = []
        ends = []
        for t in texts:
            pieces += self.pattern.findall(t)
            ends.append(len(pieces))
        if not pieces:
            return [np.empty(0, np.int32) for _ in texts]
        if len(self.known) > KEPT_PIECES or self.used > 4 * KEPT_PIECES:
            self._forget()
        if new := sorted(set(pieces).difference(self.known)):
            self._learn(new)
        codes = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        sizes = self.length[codes]
        stops = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.start[codes] - (stops - sizes), sizes) + np.arange(stops[-1])]
        cut = np.concatenate(([0], stops))[np.array([0, *ends])]
        return [ids[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text; long lists are worked off in parts of bounded size."""
        out: list[np.ndarray] = []
        part: list[str] = []
        chars = 0
        for t in texts:
            part.append(t)
            chars += len(t)
            if chars >= CHARS_AT_ONCE:
                out += self.encode_batch(part)
                part, chars = [], 0
        return out + self.encode_batch(part)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> ByteBpe:
    """One codec for each worker process and vocabulary."""
    return ByteBpe(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the ids of a text column as little-endian unsigned 32-bit integers in a binary column."""

    def compute() -> Callable[[list], list]:
        bpe = codec(path, pattern)
        return lambda texts: [x.astype("<u4").tobytes() for x in bpe.encode([t or "" for t in texts])]

    return append_column(docs, text, ids, T.BinaryType(), compute)


def decode(coded: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """Adds the bytes that a binary id column stands for."""

    def compute() -> Callable[[list], list]:
        bpe = codec(path, pattern)
        return lambda rows: [bpe.decode(np.frombuffer(x or b"", "<u4")) for x in rows]

    return append_column(coded, ids, out, T.BinaryType(), compute)


def n_ids(ids: Column) -> Column:
    return (F.length(ids) / 4).cast("long")
