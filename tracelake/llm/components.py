"""Connected components of a table of links, by alternating large and small stars.

Links stay in tables of the shared folder, one per round; only their number and a checksum
reach the driver, and the few hot nodes by name. A node with very many links costs one joined row per
link, never a group in one task: minima are taken with map-side combine and joined back, to the links of
a hot node over salts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.skew import hot_keys, meet
from tracelake.session import materialize


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node that is not the smallest of its component.

    A link to itself or with a null end says nothing; an empty table has no rows.
    """
    now = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    now = materialize(now, "links")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # a node has no more links in either join below
        hot = hot_keys(both, "u", 2 * state[0])
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = meet(both.filter("v > u"), least, "u", hot).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # every row has u > v here, so the small star's neighbours are the rows of u
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = meet(large, least, "u", hot)
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        now = materialize(small, "links")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
