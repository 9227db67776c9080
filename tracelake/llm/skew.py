"""Joins by a key that may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST = 500       # hot keys that are told apart: a key beyond them has less than one part in so many of the rows
LEAST = 50_000   # rows that one task takes without harm: below it no key is hot, and one copy of the other side meets so many


def hot_keys(rows: DataFrame, key: str, bound: int) -> dict:
    """The ``MOST`` keys with most rows, of those with more than ``LEAST``, and their numbers of rows.

    ``bound`` is what ``rows`` has at most; a table of a few times ``LEAST`` is not searched, as tasks take its keys.
    """
    if bound <= 20 * LEAST:
        return {}
    counts = rows.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))
    return {r["key"]: r["n"] for r in counts.filter(F.col("n") > LEAST).orderBy(F.desc("n"), "key").limit(MOST).collect()}


def meet(rows: DataFrame, table: DataFrame, key: str, hot: dict) -> DataFrame:
    """``rows`` joined with ``table`` (one row per key).

    Rows of a hot key are dealt by hash over salts, for each of which its row of ``table`` is copied.
    """
    if not hot:
        return rows.join(table, key)
    some = F.col(key).isin(list(hot))
    salts = 1 + max(hot.values()) // LEAST
    dealt = rows.filter(some).withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
    copies = table.filter(some).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.filter(~some).join(table, key).unionByName(dealt.join(copies, [key, "_salt"]).drop("_salt"))
