"""Approximate search by hash tables: recall, probes, hot buckets, what is read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelake.operators import hashing as hs
from tracelake.operators.search import cosine_topk

SCHEMA = "vec_id long, embedding array<double>"


def frame(spark, x, schema=SCHEMA):
    return spark.createDataFrame([(i, v if v is None else [float(a) for a in v]) for i, v in enumerate(x)], schema).repartition(4)


def asked(spark, x):
    return frame(spark, x, "query_id long, query_vec array<double>")


def made(n=4000, dim=16, groups=40, seed=0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, dim))
    return centre[rng.integers(0, groups, n)] + 0.4 * rng.normal(size=(n, dim)) + 2.0, rng


@pytest.mark.parametrize("target", [0.9, 0.99])
def test_recall_against_the_exact_search(spark, target):
    x, rng = made()
    vectors, queries = frame(spark, x), asked(spark, x[rng.integers(0, 4000, 120)] + 0.1 * rng.normal(size=(120, 16)))
    index = hs.build_hash_index(vectors)
    found = hs.hashed_topk(queries, index, 10, min_recall=target)
    exact = cosine_topk(queries, vectors, 10)
    assert hs.measured_recall(found, exact) >= target - 0.05  # the audit saw half of the queries
    truth = {(r["query_id"], r["vec_id"]): r["similarity"] for r in exact.collect()}
    for r in found.collect():
        if (r["query_id"], r["vec_id"]) in truth:
            assert r["similarity"] == pytest.approx(truth[r["query_id"], r["vec_id"]], abs=1e-9)
    assert found.groupBy("query_id").agg(F.count("*").alias("n")).filter("n <> 10").count() == 0


def test_probes_widen_the_search_and_own_bucket_comes_first(spark):
    x, _ = made(1000)
    index = hs.build_hash_index(frame(spark, x), tables=2, bits=8)
    queries = asked(spark, x[:50])
    sizes = []
    for probes in (1, 4, 16):
        pairs = hs.hashed_candidates(queries, index, probes, "query_id", "query_vec")
        assert pairs.filter("query_id = vec_id").count() == 50  # a vector lies in its own bucket
        sizes.append(pairs.count())
    assert sizes[0] < sizes[1] < sizes[2] < 50 * 1000
    whole = hs.hashed_candidates(queries, hs.build_hash_index(frame(spark, x), tables=1, bits=4), 16, "query_id", "query_vec")
    assert whole.count() == 50 * 1000  # all sixteen buckets


def test_only_probed_folders_are_read(spark):
    x, _ = made(3000)
    index = hs.build_hash_index(frame(spark, x), tables=2, bits=8)
    probes = hs._probes(asked(spark, x[:1]), index, "query_id", "query_vec", 1)
    read = hs._named(index, probes)
    assert read.collect()
    leaf = read._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert leaf.metrics().apply("numFiles").value() <= 2 < 64 == len(index.entries.inputFiles())


def test_a_bucket_of_copies_is_salted(spark, monkeypatch):
    monkeypatch.setattr(hs, "SALT_ROWS", 50)
    x, rng = made(1200)
    x[:500] = x[0]
    index = hs.build_hash_index(frame(spark, x))
    assert index.sizes.agg(F.max("salts")).first()[0] >= 10
    found = hs.hashed_topk(asked(spark, x[[0, 700]]), index, 5, min_recall=1.0).orderBy("query_id", "rank_no").collect()
    assert [r["vec_id"] for r in found if r["query_id"] == 0] == [0, 1, 2, 3, 4]
    assert all(r["similarity"] == pytest.approx(1.0) for r in found if r["query_id"] == 0)


def test_odd_vectors_and_empty_tables(spark):
    rows = [[1.0, 0.0], None, [0.0, 0.0], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, 2.0, 3.0], [0.0, 2.0], [1.0, 1.0]]
    index = hs.build_hash_index(frame(spark, rows))
    assert sorted(r["vec_id"] for r in index.vectors.collect()) == [0, 6, 7]
    got = hs.hashed_topk(asked(spark, [[1.0, 0.1], None, [0.0, 0.0], [1.0, 2.0, 3.0]]), index, 2, min_recall=1.0).collect()
    assert [(r["query_id"], r["vec_id"], r["rank_no"]) for r in sorted(got)] == [(0, 0, 1), (0, 7, 2)]
    empty = hs.build_hash_index(spark.createDataFrame([], SCHEMA))
    assert hs.hashed_topk(asked(spark, [[1.0]]), empty).count() == 0
    assert hs.hashed_topk(asked(spark, [[1.0, 2.0]]).limit(0), index).count() == 0


def test_too_little_recall_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(hs, "FLIPS", 1)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 32))
    index = hs.build_hash_index(frame(spark, x), tables=1, bits=8)
    with pytest.raises(RuntimeError, match="stays below"):
        hs.hashed_topk(asked(spark, rng.normal(size=(20, 32))), index, 10, probes=1)
