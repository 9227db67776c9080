"""Near-duplicate vectors by a robust-pruned flat graph.

1. Equal vectors of a label become one node. A label with more than ``2 * BLOCK`` nodes is cut into
   shards: centroids are fitted on a hash sample of about ``SAMPLE`` nodes (the only thing that is
   sampled); every node gets a home, the nearest centroid's shard, and joins at least one more and all with
   nearly the same cosine: within ``slack``, or within the part of it, a quarter at least, at which nodes join
   ``JOINED`` shards on average. Vectors without clusters are alike to all centroids, and with the whole slack
   would join a share of all shards, so that work would grow with the square of a label. Shards that are still
   larger are cut again, fitted on a sample of their own, so shards stay small whatever the size of a label.
   A shard of which a cut would put more than half into one part, as most of it is a dense group whose nodes
   join the same parts, stays whole; so every cut halves a shard at least.
2. Each shard, cut into blocks of at most about ``BLOCK`` nodes by hash, gets a robust-pruned graph.
   Adjacency lists of a node from all its shards are united.
3. Every node searches all blocks of its home shard: its own one from itself, others from their medoids. The
   search widens as long as it meets rows in range; each cosine is the full one in double precision. A node that
   is met by one whose home it has not joined counts that one as well, so links count at both ends.
4. The links of a sample of nodes are compared with brute force over all nodes of their label, by pairs and by
   nodes (so that a dense group does not outweigh the rest). If either recall is below ``min_recall`` the
   search is repeated with a wider beam and overlap, never again with a part of the slack; after ``attempts`` an
   error is raised.

A dense group (all vectors within range of each other) is dealt over blocks of nodes and
chunks of queries; tasks give counts per node and a forest of links, never all pairs.

Defined results: vectors that are null, empty, zero or hold a null or non-finite number, a
null label or a null id link with nothing; vectors of other length are never compared;
repeated rows count each other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tracelake.llm.components import components
from tracelake.llm.proximity import range_searches, robust_prune
from tracelake.llm.stored import store

SAMPLE = 4096
TARGET = 500           # nodes that are at home in a shard
BLOCK = 2048
QUERIES = 4096
DEGREE, CANDIDATES, ALPHA, FAR = 24, 64, 1.2, 6
GROUP = ["label", "dim"]
CELL = [*GROUP, "shard"]
JOINED = 3.0           # shards that a node may join on average; fewer, or none, are made where it would be more
LOCAL = 3              # a search that sets out from its own row has a beam so many times narrower


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def nodes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows with their node's key, and the nodes: ``label, dim, d0, d1, node, copies, vector``."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"),
                          F.col("label").cast("string").alias("label"))
    usable = F.expr("""vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL
        AND NOT exists(vector, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))""")
    length = F.expr("aggregate(vector, 0D, (a, x) -> a + x * x)")
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    rows = rows.withColumn("usable", F.when(F.col("usable"), length > 0).otherwise(False) & F.when(F.col("usable"), length < float("inf")).otherwise(False))
    rows = rows.withColumn("dim", F.size("vector")).withColumn("d0", F.xxhash64("vector")).withColumn("d1", F.xxhash64(F.lit(7), "vector"))
    given = "vector" if vectors.schema["embedding"].dataType != ArrayType(FloatType()) else F.col("vector").cast("array<float>").alias("vector")
    found = rows.filter("usable").groupBy(*GROUP, "d0", "d1").agg(F.min(F.struct("vec_id", given)).alias("_m"), F.count("*").alias("copies"))
    return rows, found.select(*GROUP, "d0", "d1", F.col("_m.vec_id").alias("node"), "copies", F.col("_m.vector").alias("vector"))


def _joins(cos: np.ndarray, slack: float) -> np.ndarray:
    """Which shards each row joins, by its cosines with their centroids: the two nearest, and all within ``slack`` of the nearest."""
    joins = cos >= cos.max(1, keepdims=True) - slack
    if cos.shape[1] > 1:
        joins[np.arange(len(cos))[:, None], np.argpartition(-cos, 1, 1)[:, :2]] = True
    return joins


def _centroids(nodes: DataFrame, sizes: DataFrame, slack: float, least: float, rounds: int = 6) -> DataFrame:
    """Unit centroids per shard that is to be cut, and the slack there: spherical k-means on a hash sample. One centroid: it stays whole."""
    share = F.lit(float(SAMPLE)) / F.col("n")
    sample = nodes.join(sizes, CELL).filter(F.pmod(F.xxhash64("node", "shard"), F.lit(1 << 30)) < share * (1 << 30))
    # a group with so few nodes that the sample may miss it is taken whole (share > 1)

    def fit(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        x = _units(_matrix(group["vector"]))[np.argsort(group["node"].to_numpy(), kind="stable")]
        k = min(max(1, round(group["n"][0].as_py() / TARGET)), max(1, len(x) // 8))
        # centroids are nearer to the rows they were fitted on, so overlap is told from others
        tried = np.arange(len(x)) % 4 == 3 if len(x) >= 64 else np.ones(len(x), bool)
        y, x = x[tried], x[~tried] if len(x) >= 64 else x
        while True:
            centre = x[np.linspace(0, len(x) - 1, k).astype(int)]
            for _ in range(rounds):
                own = (x @ centre.T).argmax(1)
                total = np.zeros_like(centre)
                np.add.at(total, own, x)
                size = np.sqrt((total * total).sum(1))
                centre = np.where((size > 0)[:, None], total / np.maximum(size, 1e-300)[:, None], centre)
            if k == 1:
                wide = slack
                break
            cos = y @ centre.T
            # two shards are joined in any case; the others' gaps to the nearest centroid, the least first
            gap = np.sort(np.sort(cos.max(1, keepdims=True) - cos, 1)[:, 2:], None)
            more = int((min(JOINED, k / 2) - 2) * len(y))
            wide = min(slack, gap[more] * (1 - 1e-9)) if 0 <= more < len(gap) else slack if more >= 0 else -1.0
            # rows of a dense group join the same shards: where one would hold most rows, cuts would repeat them without end
            if wide >= least and _joins(cos, wide).mean(0).max() <= 0.5:
                break
            k = k // 2 if k > 4 else 1
        key = {c: pa.array([group[c][0].as_py()] * k, t) for c, t in (("label", pa.string()), ("dim", pa.int32()), ("shard", pa.int64()))}
        return pa.table({**key, "child": pa.array(range(k), pa.int32()), "slack": pa.array([float(wide)] * k),
                         "centre": pa.array(list(centre), pa.list_(pa.float64()))})

    return sample.select(*CELL, "n", "node", "vector").groupBy(*CELL).applyInArrow(
        fit, "label string, dim int, shard long, child int, slack double, centre array<double>")


def _assign(nodes: DataFrame, sizes: DataFrame, centres: DataFrame) -> DataFrame:
    """Each node once per child that it joins; ``home`` where child and shard are its nearest."""
    salts = F.ceil(F.col("n") / F.lit(QUERIES)).cast("int")
    left = nodes.join(sizes, CELL).withColumn("salt", F.pmod(F.xxhash64("node"), salts).cast("int"))
    right = centres.join(sizes, CELL).withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    schema = f"label string, dim int, shard long, child int, home boolean, done boolean, node long, copies long, vector {nodes.schema['vector'].dataType.simpleString()}"

    def join(own: pa.Table, told: pa.Table) -> pa.Table:
        own = own.combine_chunks()
        count = told.num_rows
        if not own.num_rows:
            child = node = np.zeros(0, np.int64)
            home = np.zeros(0, bool)
        else:
            cos = _units(_matrix(own["vector"])) @ (_matrix(told["centre"]).T if count else np.zeros((len(own["vector"][0]), 1)))
            best = cos.argmax(1)
            node, at = np.nonzero(_joins(cos, told["slack"][0].as_py() if count else 0.0))
            home = (best[node] == at) & own["home"].to_numpy(zero_copy_only=False)[node]
            child = told["child"].to_numpy()[at] if count else at
        take = own.take(pa.array(node))
        return pa.table({"label": take["label"], "dim": take["dim"], "shard": take["shard"], "child": pa.array(child, pa.int32()), "home": pa.array(home),
                         "done": pa.array(np.full(len(node), count <= 1)), "node": take["node"], "copies": take["copies"], "vector": take["vector"]})

    return left.select(*CELL, "salt", "home", "node", "copies", "vector").groupBy(*CELL, "salt").cogroup(
        right.select(*CELL, "salt", "child", "slack", "centre").groupBy(*CELL, "salt")).applyInArrow(join, schema)


def _shards(nodes: DataFrame, slack: float, least: float | None = None) -> DataFrame:
    """``label, dim, shard, home, node, copies, vector`` of each node once per shard that it joins, with its home and all its shards.

    Levels are few: each cuts a shard into parts of about ``TARGET`` nodes and their overlap, ``SAMPLE / 8`` at most.
    Where the whole slack makes too much of that it is narrowed, to ``least`` at most.
    """
    least = slack if least is None else least
    member = nodes.select(*GROUP, F.lit(0).cast("long").alias("shard"), F.lit(True).alias("home"), F.lit(False).alias("done"), "node", "copies", "vector")
    while True:
        sizes = member.filter("NOT done").groupBy(*CELL).agg(F.count("*").alias("n")).filter(F.col("n") > 2 * BLOCK)
        sizes = store(sizes, "sizes")
        if not sizes.head(1):
            break
        cut = member.filter("NOT done").join(sizes.select(*CELL), CELL, "left_semi")
        rest = member.join(sizes.select(*CELL).withColumn("_cut", F.lit(True)), CELL, "left").filter(F.col("_cut").isNull() | F.col("done")).drop("_cut")
        centres = store(_centroids(cut, sizes, slack, least), "centres")
        parts = _assign(cut, sizes, centres).withColumn(
            "shard", F.when(F.col("done"), F.col("shard")).otherwise(F.xxhash64("shard", "child"))).drop("child")
        member = store(rest.unionByName(parts), "shards")
    joined = member.groupBy("node").agg(F.max(F.when(F.col("home"), F.col("shard"))).alias("at_home"), F.collect_set("shard").alias("shards"))
    return store(member.drop("done").join(joined, "node"), "shards")


def _graphs(member: DataFrame) -> DataFrame:
    """``node, linked``: adjacency lists of all blocks, united per node."""
    def build(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        x = _units(_matrix(group["vector"]))
        node = group["node"].to_numpy()
        linked = robust_prune(x @ x.T, DEGREE, CANDIDATES, ALPHA, FAR)
        return pa.table({"node": group["node"], "linked": pa.array([node[v] for v in linked], pa.list_(pa.int64()))})

    lists = member.groupBy(*GROUP, "shard", "block").applyInArrow(build, "node long, linked array<long>")
    return lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("linked"))).alias("linked"))  # a few lists per node


def _search(member: DataFrame, graph: DataFrame, blocks: DataFrame, threshold: float, beam: int) -> DataFrame:
    """``kind, a, b``: for each node and block the rows in range (kind 0: a node, b rows), and forests of links (kind 1)."""
    own = member.join(graph, "node")
    counts = blocks.withColumn("chunks", F.ceil(F.col("size") / F.lit(QUERIES)).cast("int"))
    dealt = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    left = own.join(counts, [*GROUP, "shard"]).withColumn("asks", F.when(F.col("home"), dealt))
    left = left.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("asks", F.coalesce(F.col("asks") == F.col("chunk"), F.lit(False)))
    # rows ask their own block from where they are, and other blocks of the shard as guests
    asks = member.filter("home").join(counts.filter("blocks > 1"), [*GROUP, "shard"]).withColumn("chunk", dealt).withColumnRenamed("block", "at")
    asks = asks.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("block <> at")
    key = [*GROUP, "shard", "block", "chunk"]

    def run(own: pa.Table, ask: pa.Table) -> pa.Table:
        kind, a, b = [], [], []
        if own.num_rows:
            own, ask = own.combine_chunks(), ask.combine_chunks()
            x, node, copies = _matrix(own["vector"]), own["node"].to_numpy(), own["copies"].to_numpy()
            order = np.argsort(node)
            lists = own["linked"].combine_chunks() if isinstance(own["linked"], pa.ChunkedArray) else own["linked"]
            flat, first = lists.flatten().to_numpy(), np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
            place = np.minimum(np.searchsorted(node[order], flat), len(node) - 1)
            here = order[place]
            inside = node[here] == flat
            linked = [here[s:e][inside[s:e]] for s, e in zip(first[:-1], first[1:])]
            u = _units(x)
            start = int((u @ u.sum(0)).argmax())
            local = np.flatnonzero(own["asks"].to_numpy(zero_copy_only=False))
            results = range_searches(x, linked, local, x[local], threshold, max(1, beam // LOCAL))
            if ask.num_rows:
                results = chain(results, range_searches(x, linked, start, _matrix(ask["vector"]), threshold, beam))
            asked = np.concatenate([node[local], ask["node"].to_numpy()])
            ids = np.unique(np.concatenate([node, asked]))
            tree, mine = np.arange(len(ids)), np.searchsorted(ids, node)
            weight, homes, back = np.concatenate([copies[local], ask["copies"].to_numpy()]), own["at_home"].to_numpy(), np.zeros(len(node), np.int64)
            joined = own["shards"].take(pa.array(local)).to_pylist() + ask["shards"].to_pylist()
            for i, (q, (hit, _)) in enumerate(zip(asked.tolist(), results)):
                hit = hit[node[hit] != q]
                if len(hit):
                    # whoever searches a shard that q has not joined cannot meet q
                    blind = np.array([h not in joined[i] for h in homes[hit].tolist()])
                    back[hit[blind]] += weight[i]
                    kind.append(0)
                    a.append(q)
                    b.append(int(copies[hit].sum()))
                    at = int(np.searchsorted(ids, q))
                    apart = hit[tree[mine[hit]] != tree[at]]
                    trees, one = np.unique(tree[mine[apart]], return_index=True)
                    for v in node[apart[one]].tolist():
                        kind.append(1)
                        a.append(min(q, v))
                        b.append(max(q, v))
                    tree[np.isin(tree, trees)] = tree[at]
            owed = np.flatnonzero(back)
            kind += [0] * len(owed)
            a += node[owed].tolist()
            b += back[owed].tolist()
        return pa.table({"kind": pa.array(kind, pa.int32()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return left.select(*key, "asks", "node", "copies", "vector", "linked", "at_home", "shards").groupBy(*key).cogroup(
        asks.select(*[F.col(c).alias(c) for c in (*key, "node", "copies", "vector", "shards")]).groupBy(*key)).applyInArrow(run, "kind int, a long, b long")


def audit_recall(nodes: DataFrame, counts: DataFrame, threshold: float, sample: int = 512) -> tuple[float, float]:
    """Recall over a hash sample of nodes, by rows in range and by nodes that have any: found by the search against
    brute force over all nodes. A count beyond the true one (a cosine at the threshold's last bit) is no gain.

    The sample has ``sample`` nodes at most whatever the input, so sending it to every task is safe.
    """
    picked = nodes.select(*GROUP, "node", "vector").orderBy(F.xxhash64(F.lit(11), "node")).limit(sample).collect()
    if not picked:
        return 1.0, 1.0
    by_group: dict[tuple, list] = {}
    for r in picked:
        by_group.setdefault((r["label"], r["dim"]), []).append((r["node"], r["vector"]))
    held = nodes.sparkSession.sparkContext.broadcast(
        {k: (np.array([n for n, _ in v]), np.array([x for _, x in v])) for k, v in by_group.items()})

    def run(batches):
        for batch in batches:
            label, dim = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            node, copies = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            ask, total, rows = [], [], {}
            for i, key in enumerate(zip(label, dim.tolist())):
                rows.setdefault(key, []).append(i)
            for key, (ids, q) in held.value.items():
                at = np.array(rows.get(key, []), np.int64)
                if len(at):
                    cos = _units(_matrix(batch.column(4).take(pa.array(at)))) @ _units(q).T
                    near = (cos >= threshold) & (node[at][:, None] != ids[None, :])
                    ask += ids.tolist()
                    total += (near * copies[at][:, None]).sum(0).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(ask, pa.int64()), pa.array(total, pa.int64())], ["node", "n"])

    want = nodes.select(*GROUP, "node", "copies", "vector").mapInArrow(run, "node long, n long").groupBy("node").agg(F.sum("n").alias("n")).filter("n > 0")
    both = [(r["n"], min(r["n"], r["links"] or 0)) for r in want.join(counts, "node", "left").collect()]
    if not both:
        return 1.0, 1.0
    return sum(h for _, h in both) / sum(w for w, _ in both), sum(h / w for w, h in both) / len(both)


def near_vectors(vectors: DataFrame, threshold: float = 0.98, beam: int = 24, slack: float = 0.15, min_recall: float = 0.99,
                 attempts: int = 3) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    rows, nodes = nodes_of(vectors)
    nodes = store(nodes, "nodes")
    for attempt in range(attempts):
        member = _shards(nodes, slack, slack if attempt else slack / 4)
        blocks = member.groupBy(*CELL).agg(F.count("*").alias("size")).withColumn("blocks", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int"))
        blocks = store(blocks, "blocks")
        member = member.join(blocks.drop("size"), CELL).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).drop("blocks")
        graph = store(_graphs(member), "graph")
        found = store(_search(member, graph, blocks, threshold, beam), "found")
        counts = store(found.filter("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("links")), "counts")
        recall = audit_recall(nodes, counts, threshold)
        if min(recall) >= min_recall:
            break
        beam, slack = 2 * beam, 2 * slack
    else:
        raise RuntimeError(f"recall {recall[0]:.4f} of pairs and {recall[1]:.4f} of nodes stays below {min_recall} after {attempts} attempts")
    labels = components(found.filter("kind = 1").select("a", "b")).withColumnRenamed("component", "_c")
    known = nodes.drop("vector").join(counts, "node", "left").join(labels, "node", "left").select(
        *GROUP, "d0", "d1", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("_c", "node").alias("_c"))
    known = store(known.filter("links > 0"), "linked")
    keys = [*GROUP, "d0", "d1"]
    out = rows.select("vec_id", *[F.when(F.col("usable"), F.col(k)).alias(k) for k in keys]).join(known, keys, "left")
    component = F.coalesce("_c", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
