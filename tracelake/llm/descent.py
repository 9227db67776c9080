"""Steps of a neighbour graph on the rows of one block, as matrix operations.

All functions work on bounded groups: a block's nodes, or its nodes and what they ask for.
"""

from __future__ import annotations

import numpy as np

NONE = np.int64(-1)


def best_in_block(x: np.ndarray, k: int, rows: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` rows of largest inner product with each row (itself left out), best first; -1 where there are fewer."""
    n = len(x)
    near, score = np.full((n, k), NONE), np.full((n, k), -np.inf, np.float32)
    c = min(k, n - 1)
    if c > 0:
        for lo in range(0, n, rows):
            s = x[lo:lo + rows] @ x.T
            at = np.arange(len(s))
            s[at, at + lo] = -np.inf
            pick = np.argpartition(-s, c - 1, 1)[:, :c]
            got = s[at[:, None], pick]
            order = np.argsort(-got, 1, kind="stable")
            near[lo:lo + rows, :c] = pick[at[:, None], order]
            score[lo:lo + rows, :c] = got[at[:, None], order]
    return near, score


def mixed(a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    """A hash of two ids, by which samples are drawn alike at every repetition of a task."""
    with np.errstate(over="ignore"):
        h = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (b.astype(np.uint64) + np.uint64(seed) * np.uint64(0xC2B2AE3D27D4EB4F))
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def pick(near: np.ndarray, wanted: np.ndarray, owner: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A mask of at most ``size`` wanted entries per row, drawn by hash."""
    if near.shape[1] == 0:
        return wanted.copy()
    order = np.where(wanted, (mixed(np.broadcast_to(owner[:, None], near.shape), near, seed) >> np.uint64(1)).astype(np.int64), np.iinfo(np.int64).max)
    rank = order.argsort(1, kind="stable").argsort(1, kind="stable")
    return wanted & (rank < size)


def top_of(owner: np.ndarray, item: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each owner's ``k`` best items, an item once; by owner and falling score."""
    order = np.lexsort((-score, item, owner))
    o, i = owner[order], item[order]
    first = np.ones(len(order), bool)
    first[1:] = (o[1:] != o[:-1]) | (i[1:] != i[:-1])
    order = order[first]
    order = order[np.lexsort((item[order], -score[order], owner[order]))]
    o = owner[order]
    start = np.flatnonzero(np.append(True, o[1:] != o[:-1])) if len(o) else np.zeros(0, np.int64)
    rank = np.arange(len(o)) - np.repeat(start, np.diff(np.append(start, len(o))))
    return order[rank < k]


def local_join(x: np.ndarray, kth: np.ndarray, at: np.ndarray, member: np.ndarray, fresh: np.ndarray, keep: int,
               cells: int = 1 << 21) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of members of one node, at least one of them fresh, that improve a list.

    ``member`` are rows of ``x``; a row's list is improved by what scores above its ``kth``.
    Gives ``(row, other row, score)``, the ``keep`` best of each row.
    """
    order = np.argsort(at, kind="stable")
    at, member, fresh = at[order], member[order], fresh[order]
    start = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(at)))
    found = []
    by_size = np.argsort(size, kind="stable")
    lo = 0
    while lo < len(by_size):
        wide = int(size[by_size[min(len(by_size) - 1, lo + 256)]])
        group = by_size[lo:lo + max(1, cells // max(1, wide * wide))]
        group = group[size[group] <= wide]
        lo += len(group)
        place = start[group][:, None] + np.arange(wide)
        real = np.arange(wide) < size[group][:, None]
        place = np.where(real, place, 0)
        rows, new = member[place], fresh[place] & real
        v = x[rows]
        s = v @ v.transpose(0, 2, 1)
        ok = (new[:, :, None] | new[:, None, :]) & real[:, :, None] & real[:, None, :]
        ok &= (s > kth[rows][:, :, None]) & (rows[:, :, None] != rows[:, None, :])
        g, i, j = np.nonzero(ok)
        a, b, c = rows[g, i], rows[g, j], s[g, i, j]
        if len(a):
            take = top_of(a, b, c, keep)
            found.append((a[take], b[take], c[take]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    a, b, c = map(np.concatenate, zip(*found))
    take = top_of(a, b, c, keep)
    return a[take], b[take], c[take]
