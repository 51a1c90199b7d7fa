"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np


def words(text):
    return text.encode().split() if text else []


def shingles(text):
    w = text.encode().lower().split() if text else []
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def components(docs, percent=80):
    """doc index -> (set size, least index reachable) by comparing all pairs that share a shingle."""
    sets = [shingles(t) for t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x])
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
        for x in s:
            holders[x].append(i)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def kept_words(docs, window=35):
    """Words left of every text when all windows that start twice are taken out."""
    split = [words(t) for t in docs]
    starts = Counter(tuple(w[k : k + window]) for w in split for k in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if starts[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        out.append([x for i, x in enumerate(w) if i not in gone])
    return out


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = [x.decode() for x in words(text)]
    lines = [x for x in text.split("\n") if words(x)]
    seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    hit = set()
    for k in range(len(w) - 7):
        if seen[tuple(w[k : k + 8])] > 1:
            hit.update(range(k, k + 8))
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def robust_distances(values, floors, share, settled, c_core, c_edge, edge, bins=200):
    """Distances by the minimum covariance determinant over one group; rows are vectors in thousandths."""
    x = np.asarray(values, np.float64)
    floors = np.asarray(floors)

    def median(v):
        s = np.sort(v, axis=0)
        return s[(len(s) + 1) // 2 - 1]

    centre = median(x)
    least = np.sqrt((1.4826 * median(np.abs(x - centre)) / 1000) ** 2 + floors**2)
    near = (np.abs(x - centre) <= 2000 * least).all(axis=1)
    centre, x = centre / 1000, x / 1000

    def distances(mean, cov):
        z = np.linalg.solve(np.linalg.cholesky(cov), (x - mean).T)
        return (z * z).sum(axis=0)

    def estimate(core, inflate):
        m = x[core].mean(axis=0)
        s = (x[core].T @ x[core] / core.sum() - np.outer(m, m)) * inflate
        return m, s + np.diag(floors**2)

    def concentrate(found):
        b = np.floor(np.log1p(distances(*found)) * bins)
        return estimate(b <= np.sort(b)[int(np.ceil(share * len(x))) - 1], c_core)

    def size(found):
        return np.linalg.slogdet(found[1])[1]

    ends = []
    for start in ((centre, np.diag(least**2)), estimate(np.ones(len(x), bool), 1.0), estimate(near, 1.0)):
        now = concentrate(start)
        while size(then := concentrate(now)) < size(now) - settled:
            now = then
        ends.append(now)
    best = min(ends, key=size)
    return distances(*estimate(distances(*best) <= edge, c_edge))
