import tracemalloc

import numpy as np
import pytest

from tests.llm.brute import groups
from tracelake.llm import vectors as V
from tracelake.llm.proximity import medoid, range_search, robust_prune
from tracelake.llm.vectors import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    ok = [(i, np.asarray(v, np.float64), label) for i, v, label in rows
          if i is not None and v is not None and label is not None and None not in v and np.isfinite(np.asarray(v, float)).all() and np.any(v)]
    links, n = [], {}
    for label in {x[2] for x in ok}:
        some = [x for x in ok if x[2] == label]
        m = np.stack([x[1] for x in some])
        norm = np.sqrt((m * m).sum(1))
        cos = (m @ m.T) / np.outer(norm, norm)
        for a, b in zip(*np.nonzero(cos >= threshold)):
            if a < b:
                links.append((some[a][0], some[b][0]))
    for a, b in links:
        n[a], n[b] = n.get(a, 0) + 1, n.get(b, 0) + 1
    root = groups([r[0] for r in rows if r[0] is not None], links)
    return {i: (n.get(i, 0), root[i]) for i in root}


def compare(spark, rows):
    got = near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        if r.vec_id is not None:
            assert (r.n_links, r.component_id) == want[r.vec_id]
            assert r.kept == (r.vec_id == r.component_id)


def f32(x):
    return [float(np.float32(v)) for v in x]


def test_planted_groups(spark, monkeypatch):
    monkeypatch.setattr(V, "TARGET", 120)
    monkeypatch.setattr(V, "BLOCK", 150)
    monkeypatch.setattr(V, "QUERIES", 100)
    rng = np.random.default_rng(2)
    rows = []
    for label in (1, 2):
        for _ in range(250):
            rows.append((len(rows), f32(rng.normal(size=24)), label))
    clump = rng.normal(size=24)
    for noise in (0.01, 0.02, 0.1, 0.2):  # from all linked to chains around the threshold
        for _ in range(60):
            rows.append((len(rows), f32(clump + noise * rng.normal(size=24)), 1))
    rows += [(len(rows) + i, rows[3][1], 1) for i in range(40)]
    rows.append((len(rows), rows[3][1], 2))
    rows += [(9001, None, 1), (9002, [0.0] * 24, 1), (9003, [float("nan")] * 24, 1), (9004, rows[0][1], None), (9005, [], 1),
             (9006, [1.0, None], 1), (None, rows[0][1], 1), (9008, [1.0, 2.0], 1), (9009, [2.0, 4.0], 1)]
    got = near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(got) == len(rows)
    want = brute([r for r in rows if r[0] not in (9008, 9009)])
    for r in got:
        if r.vec_id in (9008, 9009):
            assert (r.n_links, r.component_id) == (1, 9008)
        elif r.vec_id is not None:
            assert (r.n_links, r.component_id, r.kept) == (*want[r.vec_id], r.vec_id == want[r.vec_id][1]), r
        else:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)


def test_given_vectors(spark):
    compare(spark, [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding", "label").collect()])


def test_shards_are_cut_again(spark, monkeypatch):
    """More nodes than one fit can cut into small shards: two levels, with links across their borders."""
    for name, value in {"TARGET": 100, "BLOCK": 150, "SAMPLE": 160, "QUERIES": 200}.items():
        monkeypatch.setattr(V, name, value)
    rng = np.random.default_rng(6)
    angle = rng.uniform(0, 2 * np.pi, 2400)
    x = np.stack([np.cos(angle), np.sin(angle)], 1) * rng.uniform(0.5, 2, (2400, 1))
    rows = [(i, f32(v), 1) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA)
    nodes = V.store(V.nodes_of(df)[1], "nodes")
    member = V._shards(nodes, 0.002)
    sizes = [r["count"] for r in member.groupBy("shard").count().collect()]
    assert len(sizes) > V.SAMPLE // 8 and sum(sizes) < 12 * 2400 and max(sizes) < 600
    assert member.filter("home").groupBy("node").count().filter("count = 1").count() == nodes.count()
    assert member.filter("home AND shard <> at_home").count() == 0
    assert member.filter("NOT array_contains(shards, at_home)").count() == 0


def test_a_dense_group_is_not_cut(spark, monkeypatch):
    for name, value in {"TARGET": 50, "BLOCK": 80, "QUERIES": 200}.items():
        monkeypatch.setattr(V, name, value)
    rng = np.random.default_rng(2)
    rows = [(i, f32(v), 1) for i, v in enumerate(np.ones((600, 8)) + 0.01 * rng.normal(size=(600, 8)))]
    member = V._shards(V.store(V.nodes_of(spark.createDataFrame(rows, SCHEMA))[1], "nodes"), 0.15)
    assert member.count() == 600 and member.select("shard").distinct().count() == 1
    compare(spark, rows)


def test_links_count_at_both_ends_beside_a_dense_group(spark, monkeypatch):
    for name, value in {"TARGET": 200, "BLOCK": 250, "QUERIES": 300}.items():
        monkeypatch.setattr(V, name, value)
    rng = np.random.default_rng(9)
    a = rng.normal(size=(400, 16))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    turn = rng.normal(size=(400, 16))
    turn -= (turn * a).sum(1, keepdims=True) * a
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    b = 0.9805 * a + np.sqrt(1 - 0.9805 ** 2) * turn
    dense = rng.normal(size=16) + 0.01 * rng.normal(size=(500, 16))
    rows = [(i, f32(v), 1) for i, v in enumerate(np.vstack([a, b, dense]))]
    compare(spark, rows)


def test_work_per_row_is_bounded_without_clusters(spark, monkeypatch):
    """Noise is alike to all centroids; its rows still join few shards, and face few rows there, and no link is lost."""
    for name, value in {"TARGET": 100, "BLOCK": 300, "QUERIES": 1000}.items():
        monkeypatch.setattr(V, name, value)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2800, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turn = rng.normal(size=(400, 64))
    turn -= (turn * x[:400]).sum(1, keepdims=True) * x[:400]
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    near = 0.982 * x[:400] + np.sqrt(1 - 0.982 ** 2) * turn
    rows = [(i, f32(v), 1) for i, v in enumerate(np.vstack([x, near]))]
    seen, whole = [], V._search

    def counted(member, graph, blocks, *a):
        faced = member.filter("home").join(blocks, V.CELL).agg({"size": "sum"}).first()[0]
        seen.append((member.count(), faced))
        return whole(member, graph, blocks, *a)

    monkeypatch.setattr(V, "_search", counted)
    compare(spark, rows)
    assert len(seen) == 1
    assert seen[0][0] <= 4 * len(rows) and seen[0][1] <= 600 * len(rows)


def test_searches_from_own_rows():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 32))
    x[500:] = x[:400] + 0.05 * rng.normal(size=(400, 32))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    sims = u @ u.T
    at = np.arange(0, 900, 3)
    found = range_search(x, robust_prune(sims, 24, 64, 1.2, 6), at, x[at], 0.98, 8, cells=1 << 16)
    assert [h.tolist() for h, _ in found] == [np.flatnonzero(s >= 0.98).tolist() for s in sims[at]]
    assert range_search(x, [np.zeros(0, np.int64)] * 900, at[:0], x[:0], 0.98, 8) == []


def test_a_dense_group_beside_others_is_not_repeated(spark, monkeypatch):
    """Centroids inside a dense group are joined by all of it; cuts that only repeat the group end."""
    for name, value in {"TARGET": 20, "BLOCK": 60, "SAMPLE": 200}.items():
        monkeypatch.setattr(V, name, value)
    rng = np.random.default_rng(6)
    centre = rng.normal(size=32)
    x = np.vstack([rng.normal(size=(2000, 32)), centre + 0.01 * rng.normal(size=(500, 32))])
    whole = V.store

    def counted(df, label):
        out = whole(df, label)
        assert label != "shards" or out.count() <= 12 * len(x)
        return out

    monkeypatch.setattr(V, "store", counted)
    compare(spark, [(i, f32(v), 1) for i, v in enumerate(x)])


def test_memory_of_a_search_in_a_dense_block():
    rng = np.random.default_rng(7)
    x = rng.normal(size=32) + 0.01 * rng.normal(size=(1000, 32))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    graph, at = robust_prune(u @ u.T, 24, 64, 1.2, 6), np.arange(400)
    tracemalloc.start()
    found = range_search(x, graph, at, x[at], 0.98, 8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(len(h) == 1000 for h, _ in found)
    assert peak < 64 << 20


def test_low_recall_of_nodes_is_an_error(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 8))
    rows = [(i, f32(v), 1) for i, v in enumerate(np.vstack([x, x + 0.001, np.ones((200, 8)) + 0.001 * rng.normal(size=(200, 8))]))]
    whole = V._search

    def half(*a, **k):  # the sparse links are lost, the dense group's stay
        return whole(*a, **k).filter("kind = 1 OR b > 5")

    monkeypatch.setattr(V, "_search", half)
    with pytest.raises(RuntimeError, match="of nodes stays below"):
        near_vectors(spark.createDataFrame(rows, SCHEMA), attempts=1)


def test_no_rows(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_graph_recall():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 32))
    x[700:] = x[:800] + 0.05 * rng.normal(size=(800, 32))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    sims = u @ u.T
    found = range_search(x, robust_prune(sims, 24, 64, 1.2, 6), medoid(sims), x, 0.98, 24)
    want = [set(np.flatnonzero(s >= 0.98)) for s in sims]
    assert sum(len(set(h) & w) for (h, _), w in zip(found, want)) >= 0.99 * sum(map(len, want))
    assert all(set(h) <= w for (h, _), w in zip(found, want))
