"""A flat proximity graph over a block of vectors: robust pruning and range-expanding search.

All functions work on the rows of one block (at most a few thousand) in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def robust_prune(sims: np.ndarray, degree: int, candidates: int, alpha: float, far: int, seed: int = 0) -> list[np.ndarray]:
    """Neighbours of every row, from all similarities of a block.

    A row keeps its nearest candidate, drops every candidate that is ``alpha`` times nearer to
    the kept one than to the row, and goes on. A few rows far away, and all reverse edges,
    keep the graph navigable; parts not reached from the medoid are tied to their nearest
    reached row.
    """
    n = len(sims)
    if n < 2:
        return [np.zeros(0, np.int64)] * n
    own = np.arange(n)
    c = min(candidates, n - 1)
    apart = -sims
    apart[own, own] = np.inf
    near = np.argpartition(apart, c - 1, 1)[:, :c]
    rank = np.argsort(apart[own[:, None], near], 1, kind="stable")
    near = near[own[:, None], rank]
    gap = np.sqrt(np.maximum(2 + 2 * apart[own[:, None], near], 0))
    alive = np.ones((n, c), bool)
    source, target = [], []
    for _ in range(min(degree, c)):
        rows = np.flatnonzero(alive.any(1))
        if not len(rows):
            break
        first = alive[rows].argmax(1)
        kept = near[rows, first]
        source.append(rows)
        target.append(kept)
        between = np.sqrt(np.maximum(2 - 2 * sims[kept[:, None], near[rows]], 0))
        alive[rows] &= alpha * between > gap[rows]
        alive[rows, first] = False
    rng = np.random.default_rng(seed)
    source += [np.repeat(own, min(far, n - 1))]
    target += [rng.integers(0, n, n * min(far, n - 1))]
    a, b = np.concatenate(source), np.concatenate(target)
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    edges = np.unique(a[a != b] * n + b[a != b])
    a, b = edges // n, edges % n
    linked = [b[x:y] for x, y in zip(np.searchsorted(a, own), np.searchsorted(a, own, "right"))]
    seen = _reached(linked, medoid(sims))
    while not seen.all():
        out, there = np.flatnonzero(~seen), np.flatnonzero(seen)
        best = sims[np.ix_(out, there)]
        i, j = np.unravel_index(best.argmax(), best.shape)
        u, v = out[i], there[j]
        linked[u], linked[v] = np.append(linked[u], v), np.append(linked[v], u)
        seen |= _reached(linked, u)
    return linked


def medoid(sims: np.ndarray) -> int:
    """The row most similar to all others."""
    return int(sims.sum(1).argmax())


def _reached(linked: list[np.ndarray], start: int) -> np.ndarray:
    seen = np.zeros(len(linked), bool)
    seen[start] = True
    edge = [int(start)]
    while edge:
        new = np.unique(np.concatenate([linked[i] for i in edge])) if edge else np.zeros(0, np.int64)
        new = new[~seen[new]].astype(np.int64)
        seen[new] = True
        edge = new.tolist()
    return seen


def range_search(x: np.ndarray, linked: list[np.ndarray], start: int | np.ndarray, queries: np.ndarray, threshold: float,
                 beam: int, cells: int = 1 << 19) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the rows with cosine at or above the threshold that the search meets, and their cosines."""
    return list(range_searches(x, linked, start, queries, threshold, beam, cells))


def range_searches(x: np.ndarray, linked: list[np.ndarray], start: int | np.ndarray, queries: np.ndarray, threshold: float,
                   beam: int, cells: int = 1 << 19, edges: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``range_search`` query by query.

    ``start`` is the row to set out from, or one for each query: a query that is a row itself sets out from there,
    among its neighbours, and does with a narrow beam. Every round expands what is new among the ``beam`` best rows met
    and everything in range; so the search grows with the number of rows in range. Where that is most of a block, a
    round has very many edges: they are followed about ``edges`` at a time. Vectors need not be of unit length.
    """
    n = len(x)
    norm = np.sqrt((x * x).sum(1))
    degree = np.array([len(v) for v in linked])
    first = np.cumsum(degree) - degree
    flat = np.concatenate(linked) if n else np.zeros(0, np.int64)
    starts = np.broadcast_to(start, len(queries))
    step = max(1, cells // max(n, 1))
    turn = np.zeros(min(step, len(queries)) * n, np.int64)
    for lo in range(0, len(queries), step):
        q = queries[lo:lo + step]
        q_norm = np.sqrt((q * q).sum(1))
        m = len(q)
        sims = np.full((m, n), -np.inf)
        met = sims.reshape(-1)
        expanded = np.zeros((m, n), bool)
        active = np.arange(m)

        def meet(a: np.ndarray, b: np.ndarray) -> None:
            for k in range(0, len(a), 1 << 15):
                i, j = a[k:k + (1 << 15)], b[k:k + (1 << 15)]
                sims[i, j] = np.einsum("ij,ij->i", q[i], x[j]) / (q_norm[i] * norm[j])

        meet(active, starts[lo:lo + step])
        while True:
            s = sims[active]
            want = s >= threshold
            top = np.argpartition(-s, min(beam, n) - 1, 1)[:, :min(beam, n)]
            r = np.arange(len(active))[:, None]
            want[r, top] |= np.isfinite(s[r, top])
            want &= ~expanded[active]
            row, node = np.nonzero(want)
            if not len(row):
                break
            row = active[row]
            expanded[row, node] = True
            active = np.unique(row)
            upto = np.cumsum(degree[node])
            cuts = np.unique(np.searchsorted(upto, np.arange(edges, upto[-1], edges)))
            for u, v in zip(np.append(0, cuts), np.append(cuts, len(row))):
                count = degree[node[u:v]]
                place = np.repeat(first[node[u:v]] - np.cumsum(count) + count, count) + np.arange(count.sum())
                key = np.repeat(row[u:v] * n, count) + flat[place]
                key = key[np.isneginf(met[key])]
                turn[key] = np.arange(len(key))
                key = key[turn[key] == np.arange(len(key))]  # of equal ones the last
                meet(key // n, key % n)
        for i in range(m):
            hit = np.flatnonzero(sims[i] >= threshold)
            yield hit, sims[i, hit]
