"""A Merkle manifest of a table: roots per group and of the whole, and every row's proof.

A leaf is the digest of a row's fields. Leaves of a group are brought into order, and every
``fanout`` consecutive nodes become their parent until one, the group's root, remains; the
groups' roots are combined likewise.

1. Leaves are sorted by range over all tasks; a leaf's number in its group is its place in its
   task plus the counts of the tasks before it. No group is sorted in one task.
2. ``fanout ** depth`` consecutive leaves are one aligned block, one row. A block keeps each
   level as one string of hex digests; fixed-width substrings of it are hashed to the level
   above. The roots of a group's blocks are the leaves of the next tier, cut into blocks again.
3. From the top down, a block hands each of its nodes the path above it. A node's siblings are
   the substrings left and right of it in its run.

Defined results: a null field is written as ``-``, any other as its UTF-8 length, a colon and
the value, so empty and null text differ; the null group comes first, then groups bytewise;
rows without key come first in their group; rows with equal keys are ordered by their leaves
(equal rows have equal leaves, so their order does not show); every row is a leaf of its own;
an empty table gives no rows; a lone row is its own subroot and root, its proof is the digest
of nothing; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.session import materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEX = 64  # characters of a digest


def leaf(fields: list[Column]) -> Column:
    """Digest of a row's fields."""
    def told(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*map(told, fields)), 256)


def numbered(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``pos`` (from 0) and ``n``, their place in and the size of their group ``grp``.

    ``order`` must tell all rows of a group apart.
    """
    keys = ["grp", *order]
    placed = materialize(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("task", F.shiftright("at", 33))
    counts = placed.groupBy("grp", "task").agg(F.min("at").alias("first"), F.count("*").alias("size"))
    group = Window.partitionBy("grp")  # a group has as many rows here as tasks hold it
    before = group.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("grp", "task", (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                           F.sum("size").over(group).alias("n"))
    return placed.join(counts, ["grp", "task"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "task", "shift")


def _blocks(nodes: DataFrame, extra: list[str], fanout: int, depth: int) -> DataFrame:
    """One row per aligned block: ``grp, block, n, members`` in order, and ``levels`` from the nodes to the block's root."""
    width = fanout ** depth
    packed = nodes.groupBy("grp", F.expr(f"pos div {width}").alias("block")).agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "h", *extra))).alias("members"))
    run = fanout * HEX
    parents = f"""CAST(array_join(transform(sequence(0, CAST((octet_length(element_at(ls, -1)) - 1) div {run} AS INT)),
        i -> sha2(substring(element_at(ls, -1), i * {run} + 1, {run}), 256)), '') AS BINARY)"""
    # blocks of one group reach the same height; a group of one block ends with its only node
    levels = f"""aggregate(sequence(1, {depth}), array(CAST(array_join(members.h, '') AS BINARY)),
        (ls, d) -> CASE WHEN n <= {width} AND octet_length(element_at(ls, -1)) = {HEX} THEN ls ELSE concat(ls, array({parents})) END)"""
    return packed.withColumn("levels", F.expr(levels)).withColumn("top", F.expr("CAST(element_at(levels, -1) AS STRING)"))


def _climb(nodes: DataFrame, extra: list[str], label: str, fanout: int, depth: int) -> tuple[list[DataFrame], DataFrame]:
    """The tiers of blocks, and ``grp, subroot`` of every group. The number of tiers is a logarithm of the largest group."""
    width, tiers, roots = fanout ** depth, [], None
    while True:
        tier = materialize(_blocks(nodes, extra, fanout, depth), label)
        tiers.append(tier)
        done = tier.filter(F.col("n") <= width).select("grp", F.col("top").alias("subroot"))
        roots = done if roots is None else roots.unionByName(done)
        if not tier.filter(F.col("n") > width).select("n").head(1):
            return tiers, roots
        nodes = tier.filter(F.col("n") > width).select(
            "grp", F.col("block").alias("pos"), F.expr(f"(n + {width - 1}) div {width}").alias("n"), F.col("top").alias("h"))
        extra = []


def _descend(tiers: list[DataFrame], top: DataFrame, carried: list[str], extra: list[str], fanout: int, depth: int) -> DataFrame:
    """``grp, pos, h, *extra, *carried, path`` of every node of the lowest tier.

    ``top`` has ``grp``, the ``path`` above each group's root and the columns handed down.
    Both joins are by unique keys: one row per group, or per block.
    """
    width, above = fanout ** depth, None
    for level in reversed(range(len(tiers))):
        tier = tiers[level].drop("top")
        told = tier.filter(F.col("n") <= width).join(top, "grp")
        if above is not None:
            told = told.unionByName(tier.filter(F.col("n") > width).join(
                above.select("grp", F.col("pos").alias("block"), "path", *carried), ["grp", "block"]))
        kept = extra if level == 0 else []
        fields = "".join(f", m.{c} AS {c}" for c in kept)
        # node i of the block is node i div fanout^l of level l
        siblings = f"""transform(slice(sequence(0, size(levels)), 1, size(levels) - 1), l -> transform(array(CAST(i div CAST(power({fanout}, l) AS BIGINT) AS INT)),
            j -> struct(CAST(substring(levels[l], (j - j % {fanout}) * {HEX} + 1, (j % {fanout}) * {HEX}) AS STRING) AS l,
                        CAST(substring(levels[l], (j + 1) * {HEX} + 1, ({fanout - 1} - j % {fanout}) * {HEX}) AS STRING) AS r))[0])"""
        nodes = f"transform(members, (m, i) -> struct(m.pos AS pos, m.h AS h{fields}, {siblings} AS own))"
        out = told.select("grp", *carried, "path", F.expr(f"inline({nodes})"))
        above = out.select("grp", "pos", "h", *kept, *carried, F.concat("own", "path").alias("path"))
        if level:
            above = materialize(above, "paths")
    return above


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "source", fields: tuple[str, ...] = FIELDS,
             observed: dict[str, Column] | None = None, fanout: int = 3, depth: int = 6) -> DataFrame:
    """``key, leaf, subroot, root, proof`` (siblings from bottom to top, each left and right), ``proof_sha256,
    folded_root, verified``.

    ``observed`` gives columns as they are found when the manifest is checked; the row's leaf is then
    computed from them and folded with the proof. ``verified`` tells whether that gives the root.
    """
    observed = observed or {}
    seen = [observed.get(f, F.col(f)) for f in fields]
    name = F.col(group).cast("string")
    rows = docs.select(
        F.when(name.isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), name)).alias("grp"), F.col(key).alias("key"),
        leaf([F.col(f) for f in fields]).alias("h"), leaf(seen).alias("seen"), F.monotonically_increasing_id().alias("tie"))
    rows = materialize(rows, "leaves")
    nodes = numbered(rows, ["key", "h", "tie"], "ordered").select("grp", "pos", "n", "h", "key", "seen")
    tiers, subroots = _climb(nodes, ["key", "seen"], "blocks", fanout, depth)
    subroots = materialize(subroots, "subroots")

    # the groups are the leaves of a tree of their own
    heads = numbered(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("subroot").alias("h")), ["name"], "heads")
    upper, root = _climb(heads.select("grp", "pos", "n", "h", "name"), ["name"], "upper", fanout, depth)
    start = root.select("grp", F.col("subroot").alias("root"), F.expr("CAST(array() AS array<struct<l:string,r:string>>)").alias("path"))
    top = _descend(upper, start, ["root"], ["name"], fanout, depth).select(F.col("name").alias("grp"), F.col("h").alias("subroot"), "root", "path")

    out = _descend(tiers, materialize(top, "tops"), ["subroot", "root"], ["key", "seen"], fanout, depth)
    proof = F.expr("transform(path, s -> concat(s.l, s.r))")
    folded = F.expr("aggregate(path, seen, (node, s) -> sha2(concat(s.l, node, s.r), 256))")
    return out.select(F.col("key").alias(key), F.col("h").alias("leaf"), "subroot", "root", F.col("path").alias("proof"),
                      F.sha2(F.array_join(proof, ""), 256).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
