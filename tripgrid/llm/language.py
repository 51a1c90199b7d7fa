"""Language identification with a bidirectional gated recurrent network over bytes.

The network is trained here, in numpy, by backpropagation through time: every position of a
stretch of bytes is labelled with its document's language. A prediction reads the whole text, cut
into segments that run side by side as columns of one matrix, labels every position, and pools the
positions' probabilities by their mean.

Training rows are a bounded sample (``per_language`` different texts of each language, a stretch of
at most ``stretch`` characters from each, both chosen by hash, at most ``languages`` languages);
everything else covers all rows.

Defined cases: null text, empty text and text without a letter are ``und`` with score 0; rows with
null lang or text are not trained on; without any labelled row all texts are ``und``; repeated rows
give repeated results; other columns are handed through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

HIDDEN = 8
SEGMENT = 128
COLUMNS = 2048
PAD = 256
BYTES_AT_ONCE = 2_000_000
LETTER = regex.compile(r"\p{L}")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Direction:
    """One direction of the network: parameters, forward pass that keeps states, backward pass."""

    def __init__(self, rng: np.random.Generator) -> None:
        h = HIDDEN
        self.p = {
            "x": rng.normal(0, 0.3, (PAD + 1, 3 * h)).astype(np.float32),
            "u": rng.normal(0, 1 / np.sqrt(h), (h, 3 * h)).astype(np.float32),
            "b": np.zeros(3 * h, np.float32),
        }

    def forward(self, ids: np.ndarray) -> np.ndarray:
        """States after each step; ``ids`` is (steps, rows)."""
        h = HIDDEN
        self.ids, self.kept = ids, []
        state = np.zeros((ids.shape[1], h), np.float32)
        out = np.empty((*ids.shape, h), np.float32)
        for t in range(len(ids)):
            a, u = self.p["x"][ids[t]], state @ self.p["u"] + self.p["b"]
            gates = _sigmoid(a[:, : 2 * h] + u[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            n = np.tanh(a[:, 2 * h :] + r * u[:, 2 * h :])
            self.kept.append((state, z, r, n, u[:, 2 * h :]))
            state = state + z * (n - state)
            out[t] = state
        return out

    def backward(self, above: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients from those of the states."""
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        da = np.empty((*self.ids.shape, 3 * HIDDEN), np.float32)
        carried = np.zeros_like(above[0])
        for t in range(len(above) - 1, -1, -1):
            before, z, r, n, un = self.kept[t]
            d = above[t] + carried
            dn = d * z * (1 - n * n)
            dz = d * (n - before) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            da[t] = np.concatenate([dz, dr, dn], axis=1)
            du = np.concatenate([dz, dr, dn * r], axis=1)
            g["u"] += before.T @ du
            g["b"] += du.sum(axis=0)
            carried = d * (1 - z) + du @ self.p["u"].T
        flat, da = self.ids.ravel(), da.reshape(-1, 3 * HIDDEN)
        order = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.diff(flat[order], prepend=-1))
        g["x"][flat[order][first]] = np.add.reduceat(da[order], first, axis=0)
        return g


def train(texts: list[bytes], labels: list[int], n_labels: int, steps: int = 220, rows: int = 192, length: int = 64, seed: int = 7) -> dict:
    """Fit the network; returns plain arrays."""
    rng = np.random.default_rng(seed)
    ahead, back = Direction(rng), Direction(rng)
    top = {"w": rng.normal(0, 0.3, (2 * HIDDEN, n_labels)).astype(np.float32), "c": np.zeros(n_labels, np.float32)}
    parts = [ahead.p, back.p, top]
    moments = [{k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()} for p in parts]
    by_label = [[i for i, y in enumerate(labels) if y == k] for k in range(n_labels)]
    for step in range(1, steps + 1):
        ids = np.full((length, rows), PAD, np.int64)
        y = np.empty(rows, np.int64)
        for c in range(rows):
            y[c] = c % n_labels  # languages in equal shares
            text = texts[by_label[y[c]][rng.integers(len(by_label[y[c]]))]]
            at = int(rng.integers(max(1, len(text) - length + 1)))
            cut = np.frombuffer(text[at : at + length], np.uint8)
            ids[: len(cut), c] = cut
        states = np.concatenate([ahead.forward(ids), back.forward(ids[::-1])[::-1]], axis=2)
        logits = states @ top["w"] + top["c"]
        p = np.exp(logits - logits.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        p[:, np.arange(rows), y] -= 1
        real = (ids != PAD)[:, :, None]
        p *= real / max(1, real.sum())
        flat = p.reshape(-1, n_labels)
        g_top = {"w": states.reshape(-1, 2 * HIDDEN).T @ flat, "c": flat.sum(axis=0)}
        below = p @ top["w"].T
        grads = [ahead.backward(below[:, :, :HIDDEN]), back.backward(below[::-1, :, HIDDEN:]), g_top]
        rate = 0.03 * (1 - step / (steps + 1))
        for part, grad, moment in zip(parts, grads, moments, strict=True):
            for k in part:  # Adam
                m, v = moment[k]
                m += 0.1 * (grad[k] - m)
                v += 0.01 * (grad[k] ** 2 - v)
                part[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return {"ahead": ahead.p, "back": back.p, "top": top}


class Reader:
    """The fitted network arranged for long columns: gates are contiguous rows."""

    def __init__(self, model: dict) -> None:
        half = np.array([0.5] * (2 * HIDDEN) + [1.0] * HIDDEN, np.float32)[:, None]
        self.sides = []
        for side in ("ahead", "back"):
            p = model[side]
            x = np.ascontiguousarray(p["x"].T * half)
            x[: 2 * HIDDEN] += p["b"][: 2 * HIDDEN, None] * 0.5
            x[:HIDDEN, PAD] = -40.0  # padding leaves the state as it is
            self.sides.append((x, np.ascontiguousarray(p["u"].T * half), p["b"][2 * HIDDEN :, None].copy()))
        self.w, self.c = np.ascontiguousarray(model["top"]["w"].T), model["top"]["c"][:, None].copy()

    def _states(self, ids: np.ndarray, side: int) -> np.ndarray:
        h, (x, u, b) = HIDDEN, self.sides[side]
        state = np.zeros((h, ids.shape[1]), np.float32)
        out = np.empty((len(ids), h, ids.shape[1]), np.float32)
        a = np.empty((3 * h, ids.shape[1]), np.float32)
        v = np.empty_like(a)
        for t in range(len(ids)) if side == 0 else range(len(ids) - 1, -1, -1):
            np.take(x, ids[t], axis=1, out=a, mode="clip")
            np.matmul(u, state, out=v)
            gates, n, un = a[: 2 * h], a[2 * h :], v[2 * h :]
            gates += v[: 2 * h]
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            un += b
            un *= gates[h:]
            n += un
            np.tanh(n, out=n)
            n -= state
            n *= gates[:h]
            state += n
            out[t] = state
        return out

    def positions(self, ids: np.ndarray) -> np.ndarray:
        """Probabilities (steps, labels, columns) of every position."""
        both = np.concatenate([self._states(ids, 0), self._states(ids, 1)], axis=1)
        p = np.matmul(self.w, both)
        p += self.c
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over all positions of each text; texts must not be empty."""
        size = np.array([len(t) for t in texts], np.int64)
        segments = -(-size // SEGMENT)
        ids = np.full(int(segments.sum()) * SEGMENT, PAD, np.int64)
        shift = (np.cumsum(segments) - segments) * SEGMENT - (np.cumsum(size) - size)
        ids[np.repeat(shift, size) + np.arange(size.sum())] = np.frombuffer(b"".join(texts), np.uint8)
        ids = np.ascontiguousarray(ids.reshape(-1, SEGMENT).T)
        total = np.empty((len(self.c), ids.shape[1]))
        for k in range(0, ids.shape[1], COLUMNS):
            part = ids[:, k : k + COLUMNS]
            p = self.positions(part)
            total[:, k : k + COLUMNS] = (p * (part != PAD)[:, None, :]).sum(axis=0)
        first = np.cumsum(segments) - segments
        return np.add.reduceat(total, first, axis=1).T / size[:, None]


def training_rows(labelled: DataFrame, per_language: int, stretch: int, languages: int = 1000) -> list[tuple[bytes, str]]:
    """A bounded sample: the ``per_language`` different texts of least hash of each language.

    Copies count once. Where there are more than ``languages`` languages, those with the most
    different texts are learned, of equal ones the first by name.
    """
    usable = labelled.filter(F.col("lang").isNotNull() & (F.length("text") > 0))
    hashed = usable.withColumn("h", F.xxhash64("text"))
    different = hashed.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["lang"]: r["n"] for r in different.orderBy(F.desc("n"), "lang").limit(languages).collect()}
    if not counts:
        return []
    # about twice as many as wanted lie below a language's limit, so few texts are ranked
    space = 1 << 30
    limits = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(space, space * 2 * per_language // n + space // n))])
    sample = hashed.filter(F.pmod("h", F.lit(space)) < F.coalesce(F.try_element_at(limits, F.col("lang")), F.lit(0)))
    at = 1 + F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(F.lit(1), F.length("text") - stretch + 1))
    rows = sample.select("lang", "h", F.pmod("h", F.lit(space)).alias("low"), F.substring("text", at.cast("int"), F.lit(stretch)).alias("t"))
    once = rows.groupBy("lang", "h", "low").agg(F.min("t").alias("t"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("low", "h")))
    taken = ranked.filter(F.col("rank") <= per_language).orderBy("low", "h", "lang").collect()
    return [(r["t"].encode(), r["lang"]) for r in taken]


def fit(labelled: DataFrame, per_language: int = 200, stretch: int = 2000, steps: int = 220) -> tuple[list[str], dict] | None:
    """Languages and network from ``lang`` and ``text``; None without a labelled row."""
    rows = training_rows(labelled, per_language, stretch)
    if not rows:
        return None
    langs = sorted({lang for _, lang in rows})
    return langs, train([t for t, _ in rows], [langs.index(x) for _, x in rows], len(langs), steps)


def predict(text: Column, fitted: tuple[list[str], dict] | None) -> Column:
    """Struct (lang, score) for a text column."""

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(fitted[1]) if fitted else None
        for batch in batches:
            lang, score = ["und"] * len(batch), [0.0] * len(batch)
            part: list[tuple[int, bytes]] = []
            held = 0

            def flush() -> None:
                for (i, _), p in zip(part, reader.documents([t for _, t in part]), strict=True):
                    best = int(p.argmax())
                    lang[i], score[i] = fitted[0][best], min(1.0, float(p[best]))
                part.clear()

            for i, text in enumerate(batch):
                if reader and text and LETTER.search(text):
                    part.append((i, text.encode()))
                    held += len(part[-1][1])
                    if held > BYTES_AT_ONCE:
                        flush()
                        held = 0
            if part:
                flush()
            yield pd.DataFrame({"lang": lang, "score": score})

    return run(text)
