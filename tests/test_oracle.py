"""Every registered query with a SQL check agrees with DuckDB on the smallest tables."""

import duckdb
import pytest

from tracelake import suite

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
suite.load()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canon(v):
    if v is None or (isinstance(v, float) and v != v):
        return None
    return repr(round(v, 9)) if isinstance(v, float) else str(v)


def rows(names, found):
    """Values as the engines give them: a frame would turn a column of integers and nulls into floats."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(canon(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("key", sorted(suite.ORACLES))
def test_agrees(spark, duck, key):
    df = suite.QUERIES[key](spark, SF)
    got = rows(df.columns, df.collect())
    told = duck.execute(suite.ORACLES[key])
    want = rows([c[0] for c in told.description], told.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


@pytest.mark.parametrize("key", sorted(set(suite.QUERIES) - set(suite.ORACLES)))
def test_runs(spark, key):
    assert suite.QUERIES[key](spark, SF).count() > 0
