"""The neighbour graph and its search against all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelake.llm import neighbours
from tracelake.llm.descent import best_in_block, local_join, top_of
from tracelake.llm.neighbours import nearest

SCHEMA = "vec_id long, embedding array<double>, NID int, score string, members int"


def plain(rows, asked, k):
    use = {(v, tuple(e)) for v, e in rows if v is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)}
    out = {}
    for v, q in use:
        if asked(v):
            near = sorted((-sum(a * b for a, b in zip(q, e)), u) for u, e in use if u != v and len(e) == len(q))
            out.setdefault(v, []).append([(u, -s) for s, u in near[:k]])
    return out


def found(spark, rows, k, **how):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    out = {}
    for r in nearest(df, F.col("vec_id") % 4 == 0, k=k, **how).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def check_exact(spark, rows, k):
    """In one block the search is exact."""
    got, want = found(spark, rows, k), plain(rows, lambda v: v % 4 == 0, k)
    assert set(got) == {v for v, lists in want.items() if lists[0]}
    for v, near in got.items():
        assert [r for r, _, _ in near] == list(range(1, len(near) + 1))
        assert [(u, round(s, 9)) for _, u, s in near] == [(u, round(s, 9)) for u, s in want[v][0]]


def test_one_block_is_exact(spark):
    rng = random.Random(2)
    check_exact(spark, [(i, [rng.gauss(0, 1) * (1 + i % 3) for _ in range(8)]) for i in range(120)], 5)


def test_copies_ties_nulls_and_lengths(spark):
    rng = random.Random(4)
    hot = [0.5, 0.25, -1.0]
    rows = [(i, hot) for i in range(60)] + [(100 + i, [rng.choice([-1.0, 0.5, 2.0]) for _ in range(3)]) for i in range(40)]
    rows += [(4, hot)] * 5 + [(None, hot), (200, None), (204, [0.0, 0.0, 0.0]), (208, [1.0, None, 2.0]), (212, [1.0, math.nan, 2.0]), (216, [1.0, math.inf, 2.0]),
             (220, []), (224, [1.0, 2.0]), (225, [2.0, 2.0]), (228, [1.0, 1.0, 1.0, 1.0])]
    check_exact(spark, rows, 7)


def test_empty_table_and_no_query(spark):
    assert nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 4 == 0).count() == 0
    assert found(spark, [(1, [1.0, 2.0]), (3, [2.0, 1.0])], 3) == {}


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in {"BLOCK": 150, "QUERIES": 40}.items():
        monkeypatch.setattr(neighbours, name, value)


def test_many_blocks_keep_recall(spark, small_blocks):
    """Scattered vectors, a dense group and a group of copies, over more than ten blocks."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(2400, 24))
    x[:700] = rng.normal(size=24) * 3 + 0.05 * rng.normal(size=(700, 24))
    x[700:1000] = x[5]
    x /= np.linalg.norm(x, axis=1, keepdims=True) / rng.uniform(0.8, 1.2, (2400, 1))
    x[700:1000] = x[5]
    order = rng.permutation(2400)
    rows = [(int(i), x[j].tolist()) for i, j in enumerate(order)]
    got, hits, total = found(spark, rows, 10, beam=48), 0, 0
    held = x[order]
    for v, near in got.items():
        score = held @ held[v]
        score[v] = -np.inf
        kth = np.sort(score)[-10]
        assert len(near) == 10 and len({u for _, u, _ in near}) == 10 and v not in {u for _, u, _ in near}
        assert all(abs(s - score[u]) < 1e-9 for _, u, s in near)
        hits += sum(s >= kth - 1e-12 for _, _, s in near)
        total += 10
    assert len(got) == 600 and hits >= 0.9 * total


def test_low_recall_is_an_error(spark, small_blocks, monkeypatch):
    monkeypatch.setattr(neighbours, "measured_recall", lambda *a, **k: 0.5)
    with pytest.raises(RuntimeError, match="recall 0.500"):
        found(spark, [(i, [float(i), 1.0]) for i in range(20)], 3, attempts=2)


def test_local_join_gives_all_improving_pairs():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 5)).astype(np.float32)
    kth = rng.normal(size=60).astype(np.float32)
    at, member = np.repeat(np.arange(12), 9), np.concatenate([rng.choice(60, 9, replace=False) for _ in range(12)])
    fresh = rng.random(108) < 0.4
    want = {}
    for g in range(12):
        inside = [(int(m), bool(f)) for m, f in zip(member[at == g], fresh[at == g])]
        for a, fa in inside:
            for b, fb in inside:
                if a != b and (fa or fb) and x[a] @ x[b] > kth[a]:
                    want[a, b] = x[a] @ x[b]
    a, b, s = local_join(x, kth, at, member, fresh, 1000, cells=200)
    assert set(zip(a.tolist(), b.tolist())) == set(want)
    a, b, s = local_join(x, kth, at, member, fresh, 2)
    for row in set(a.tolist()):
        assert sorted(s[a == row]) == pytest.approx(sorted(v for (i, _), v in want.items() if i == row)[-2:], abs=1e-5)


def test_best_in_block_and_top_of():
    x = np.random.default_rng(0).normal(size=(50, 4)).astype(np.float32)
    near, score = best_in_block(x, 6, rows=7)
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    assert (np.sort(s, 1)[:, :-7:-1] == pytest.approx(score, abs=1e-5))
    assert best_in_block(x[:1], 3)[0].tolist() == [[-1, -1, -1]]
    take = top_of(np.array([2, 1, 2, 2, 2]), np.array([5, 5, 5, 6, 7]), np.array([1.0, 9.0, 3.0, 2.0, 0.0]), 2)
    assert take.tolist() == [1, 2, 3]
