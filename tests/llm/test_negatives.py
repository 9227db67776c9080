"""Hard negatives against all pairs, and the vertical scan's bounds by themselves."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelake.llm.negatives import mine, vertical

SCHEMA = "vec_id long, label string, embedding array<double>, score long, BLOCK int"


def plain(rows, anchor, positives=5, negatives=3, low=50, high=95, scale=256):
    use = [(v, lab, [math.floor(scale * x) for x in e]) for v, lab, e in rows
           if v is not None and lab is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, (a, la, q) in enumerate(use):
        if not anchor(a):
            continue
        scored = [(-sum(x * y for x, y in zip(q, e)), v, j, lab == la) for j, (v, lab, e) in enumerate(use) if j != i and len(e) == len(q)]
        for ps, p, _, _ in sorted(s for s in scored if s[3])[:positives]:
            window = sorted(s for s in scored if not s[3] and low * -ps <= 100 * -s[0] <= high * -ps)
            out += [(a, p, r, n, -ps, -ns) for r, (ns, n, _, _) in enumerate(window[:negatives], 1)]
    return sorted(out)


def check(spark, rows, **sizes):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    got = sorted(tuple(r) for r in mine(df, F.col("vec_id") % 5 == 0, **sizes).collect())
    assert got == plain(rows, lambda v: v % 5 == 0)
    return got


@pytest.mark.parametrize("sizes", [{}, {"block": 20, "anchor_block": 7}])
def test_equals_all_pairs(spark, sizes):
    rng = random.Random(3)
    rows = [(i, f"l{rng.randrange(4)}", [rng.gauss(0.05, 0.2) for _ in range(20)]) for i in range(200)]
    assert len(check(spark, rows, **sizes)) > 100


def test_ties_repeats_nulls_and_lengths(spark):
    rng = random.Random(5)
    few = [[rng.choice([0.0, 0.25, 0.5]) for _ in range(3)] for _ in range(4)]
    rows = [(i, rng.choice("ab"), few[i % 4]) for i in range(40)] + [(5, "a", few[1])] * 3 + [(6, "b", few[1])] * 3
    rows += [(None, "a", few[0]), (50, None, few[0]), (55, "a", None), (60, "a", [0.1, None, 0.2]), (65, "b", [0.1, math.nan, 0.2]),
             (70, "b", [math.inf, 0.1, 0.2]), (75, "a", [0.0, 0.0, 0.0]), (80, "a", []), (81, "b", []), (85, "a", [0.5, 0.5]), (86, "a", [0.5, 0.25]),
             (87, "b", [0.25, 0.25]), (90, "a", [3e6, -2e6, 1e6]), (91, "a", [2.5e6, -2e6, 1e6]), (92, "b", [2e6, -1e6, 1e6])]
    assert any(abs(r[4]) > 1 << 53 for r in check(spark, rows, block=8, anchor_block=3))


def test_empty_table(spark):
    assert mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 5 == 0).count() == 0


def test_scan_drops_only_rows_out_of_reach():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(0, 60, (400, 24)))
    low, high, k = [500, -200], [3000, 400], 3
    pruned = 0
    for q in np.floor(rng.normal(0, 60, (20, 24))):
        exact = x @ q
        alive, score = vertical(x.T.copy(), x.min(0), x.max(0), q, np.arange(400), low, high, [-np.inf] * 2, k)
        assert (exact[alive] == score).all()
        for lo, hi in zip(low, high):
            inside = sorted(exact[(exact >= lo) & (exact <= hi)])[-k:]
            assert sorted(score[(score >= lo) & (score <= hi)])[-k:] == inside
        pruned += 400 - len(alive)
    assert pruned > 4000
