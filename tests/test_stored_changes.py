"""Growing digests and tables that are changed in place."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tracelake.operators import cards, digest
from tracelake.sources import hashed

TURNS = "session_id string, turn_index long, role string, content string"


def made(n=200):
    rng = random.Random(4)
    rows, at = [], {}
    for _ in range(n):
        s = f"s{rng.randrange(5)}"
        at[s] = at.get(s, -3) + rng.randint(1, 4)
        rows.append((s, at[s], rng.choice(["user", "assistant"]), rng.choice(["hello  there", "", "x" * 50, "two\nlines"])))
    return rows


@pytest.mark.parametrize("cuts", [(0, 200), (0, 1, 200), (0, 50, 50, 120, 199, 200)])
def test_any_split_gives_the_fingerprint_of_the_whole(spark, cuts):
    rows = made()
    state, read = spark.createDataFrame([], digest.STATE), 0
    for a, b in zip(cuts, cuts[1:]):
        turns = spark.createDataFrame(rows[max(0, a - 30):b], TURNS)  # the last thirty come again
        read += digest.unseen(turns, state).count()
        state = spark.createDataFrame(digest.grown(state, turns).collect(), digest.STATE)
    whole = {tuple(r) for r in cards.fingerprint(spark.createDataFrame(rows, TURNS)).collect()}
    assert {tuple(r) for r in digest.fingerprint_of(state).collect()} == whole
    assert read == len(rows)  # each turn once


def test_equal_content_in_another_order_differs(spark):
    rows = [("a", 0, "user", "x"), ("a", 1, "user", "y"), ("b", 0, "user", "y"), ("b", 1, "user", "x"), ("c", 5, "user", "x"), ("c", 9, "user", "y")]
    got = {r["session_id"]: r["fingerprint"] for r in digest.fingerprint_of(digest.digest_state(spark.createDataFrame(rows, TURNS))).collect()}
    assert got["a"] != got["b"] and got["a"] == got["c"]


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


ROWS = "k string, n int, v string"


def test_only_touched_folders_change(spark, tmp_path):
    path = str(tmp_path / "t")
    hashed.write_hashed(spark.createDataFrame([(f"k{i}", j, f"old{i}") for i in range(300) for j in range(2)], ROWS), path, "k", 16)
    before = files(path)
    change = spark.createDataFrame([("k7", 1, "new"), ("k9", 5, "more"), ("kx", 0, "other")], ROWS)
    written = hashed.upsert_hashed(spark, path, change, "k", ["k", "n"], 16)
    after = files(path)
    assert 1 <= len(written) <= 3
    same = {f for f in before if before[f] == after.get(f)}
    assert {f for f in before if not any(f"part={p}/" in f for p in written)} == same
    want = {(f"k{i}", j): f"old{i}" for i in range(300) for j in range(2)} | {("k7", 1): "new", ("k9", 5): "more", ("kx", 0): "other"}
    assert {(r["k"], r["n"]): r["v"] for r in hashed.read_hashed(spark, path).collect()} == want
    hashed.upsert_hashed(spark, path, change, "k", ["k", "n"], 16)  # again: nothing changes
    assert hashed.read_hashed(spark, path).count() == len(want)


def test_removing_all_rows_of_a_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(f"k{i}", i, "") for i in range(40)], ROWS)
    hashed.write_hashed(rows, path, "k", 4)
    gone = rows.filter(hashed.part_of("k", 4) == 2).unionByName(rows.filter("k = 'k3'")).select("k")
    ids = {r["k"] for r in gone.collect()}
    written = hashed.remove_hashed(spark, path, gone, "k", 4)
    assert 2 in written and not os.path.exists(f"{path}/part=2")
    assert {r["k"] for r in hashed.read_hashed(spark, path).collect()} == {f"k{i}" for i in range(40)} - ids
    assert hashed.remove_hashed(spark, path, gone.limit(0), "k", 4) == []
