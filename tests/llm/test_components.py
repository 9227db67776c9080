"""Connected components against union-find, with centres that hold most links."""

import random

import pytest

from tracelake.llm import skew
from tracelake.llm.components import components


def plain(links):
    tree = {}

    def root(x):
        while tree.setdefault(x, x) != x:
            x = tree[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        tree[b] = a
    return {x: root(x) for x in tree if root(x) != x}


@pytest.mark.parametrize("least", [5, 1000])
def test_hot_centres_chains_and_scattered_links(spark, monkeypatch, least):
    monkeypatch.setattr(skew, "LEAST", least)
    rng = random.Random(3)
    links = [(500, i) for i in range(1000, 1400)] + [(9000, i) for i in range(2000, 2300)] + [(i, i + 1) for i in range(3000, 3060)]
    links += [(rng.randrange(4000, 4400), rng.randrange(4000, 4400)) for _ in range(300)] + [(1100, 2100), (7, 7)]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long").repartition(3)
    if least == 5:
        assert set(skew.hot_keys(df, "a", df.count())) >= {500, 9000}
        monkeypatch.setattr(skew, "MOST", 1)
        assert skew.hot_keys(df, "a", df.count()) == {500: 400}
        monkeypatch.setattr(skew, "MOST", 500)
    assert {r["node"]: r["component"] for r in components(df).collect()} == plain(links)


def test_rows_of_hot_keys_meet_their_one_partner(spark, monkeypatch):
    monkeypatch.setattr(skew, "LEAST", 10)
    rows = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(600)] + [(None, 1)], "k long, x long")
    table = spark.createDataFrame([(i, f"t{i}") for i in range(400)], "k long, t string")
    hot = skew.hot_keys(rows, "k", rows.count())
    assert set(hot) == {1}
    assert sorted(map(tuple, skew.meet(rows, table, "k", hot).collect())) == sorted(map(tuple, rows.join(table, "k").collect()))
