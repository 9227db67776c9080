"""Nearest neighbours by inner product: a neighbour graph by NN-descent, searched greedily.

1. Equal vectors become one node that knows its smallest ids. A vector x gets one more component,
   ``sqrt(M - |x|^2)`` with M the largest squared length, so that nearness by inner product and by
   angle agree; codes of half precision of these are what the graph is built from.
2. Two sets of hyperplanes cut the nodes into blocks of about ``BLOCK``, larger ones by hash. The best
   of a node's block are its first neighbours; its first block is its home, which its number names.
3. NN-descent: each round draws fresh and old neighbours of every node, forwards and backwards, at
   most ``FRESH`` and ``OLD`` of each, and joins them with their codes. Members of one node's draw
   are neighbours of neighbours; pairs that improve a list are sent home. It ends when few do.
4. Queries start from their home block. Each hop expands the best nodes not yet expanded of every
   query's beam: their neighbours, both ways, are fetched once per group of queries and scored.
5. The best nodes are scored again on the original vectors, in double precision.
6. A hash sample of queries is compared with all rows. Below ``min_recall`` the beam is doubled and the search
   goes on; if that does not help in ``attempts``, an error is raised.

Only hyperplanes and audited queries, whose numbers are constants, reach the driver.

Defined results: vectors that are null, zero (or so small or large that the squared length is 0 or infinite)
or hold a null or non-finite number, and rows without id, take no part; a repeated (id, vector) counts once;
an id with several vectors is a candidate with each and, as a query, never its own neighbour; vectors of other
length are never compared; ties go to the smaller id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm.descent import best_in_block, local_join, pick, top_of
from tracelake.llm.stored import store

BLOCK = 16384          # nodes of a block, about
DEGREE = 24            # neighbours of a node
FRESH, OLD = 16, 8     # neighbours of a node drawn in a round, each way
SENT = 12              # improvements of a list that one block sends home
PLANES = 40            # hyperplanes at most: blocks for any number of nodes
QUERIES = 768          # queries of a group at most
EXPANDED = 24          # nodes that a query expands in a hop
INDEX = 20             # bits of a node's number inside its home
PLAIN, NEW, DRAWN_NEW, DRAWN_OLD = 0, 1, 2, 3
LISTS = "home long, nid long, ids array<long>, scores array<float>, state array<byte>"
CANDIDATES = "home long, nid long, item long, score float"


def nodes_of(vectors: DataFrame, queries: Column, members: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors ``dim, d0, d1, x, members`` (the smallest ids), and the queries ``vec_id, dim, d0, d1``."""
    x = F.col("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"), F.coalesce(queries, F.lit(False)).alias("asked"))
    usable = F.expr("""vec_id IS NOT NULL AND x IS NOT NULL AND size(x) > 0 AND NOT exists(x, v -> v IS NULL OR isnan(v) OR abs(v) = double('Infinity'))
        AND aggregate(x, 0D, (a, v) -> a + CAST(v AS DOUBLE) * CAST(v AS DOUBLE)) BETWEEN double('4.9E-324') AND double('1.7976931348623157E308')""")
    rows = rows.filter(F.coalesce(usable, F.lit(False))).withColumn("dim", F.size("x")).withColumn(
        "d0", F.xxhash64("x")).withColumn("d1", F.xxhash64(F.lit(7), "x"))
    key = ["dim", "d0", "d1"]
    ids = rows.groupBy("vec_id", *key).agg(F.max("asked").alias("asked"))
    least = ids.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy("vec_id"))).filter(F.col("rank") <= members)
    held = rows.groupBy(*key).agg(F.first("x").alias("x"), F.max("asked").alias("asked")).join(
        least.groupBy(*key).agg(F.sort_array(F.collect_list("vec_id")).alias("members")), key)
    return held, ids.filter("asked").select("vec_id", *key)


def _floats(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _codes(column: pa.Array, kind=np.float16) -> np.ndarray:
    n = len(column)
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(n, -1).astype(np.float32) if n else np.zeros((0, 1), np.float32)


def _table(schema: str, *columns) -> pa.Table:
    types = {"long": pa.int64(), "float": pa.float32(), "boolean": pa.bool_(), "binary": pa.binary(), "int": pa.int32(), "array<long>": pa.list_(pa.int64()),
             "array<float>": pa.list_(pa.float32()), "array<byte>": pa.list_(pa.int8())}
    names, kinds = zip(*(c.strip().split(" ", 1) for c in schema.split(", ")))
    return pa.table([pa.array(c, types[k]) for c, k in zip(columns, kinds)], names=list(names))


def _signed(nodes: DataFrame, seed: int) -> DataFrame:
    """Adds ``s0`` and ``s1``: sides of two sets of hyperplanes between vectors of a hash sample, as many as the blocks need."""
    order = Window.partitionBy("dim").orderBy(F.xxhash64(F.lit(seed), "d0"), "d0", "d1")
    sample = nodes.select("dim", "d0", "d1", "x", F.row_number().over(order).alias("r")).filter(F.col("r") <= 4 * PLANES).orderBy("dim", "r").collect()
    counts = {r["dim"]: r["n"] for r in nodes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    planes = {}
    for dim, n in counts.items():
        x = np.array([r["x"] for r in sample if r["dim"] == dim], np.float64)
        need = min(int(np.ceil(np.log2(max(1.0, n / BLOCK)))), PLANES, len(x) // 4)
        a, b = x[0:4 * need:2], x[1:4 * need:2]
        planes[dim] = ((a - b).T, ((a + b) / 2 * (a - b)).sum(1), need)

    def run(batches):
        for batch in batches:
            dim = batch.column("dim").to_numpy()
            s = np.zeros((2, len(dim)), np.int64)
            for d in np.unique(dim).tolist():
                at = np.flatnonzero(dim == d)
                w, t, need = planes[d]
                side = (_floats(batch.column("x").take(pa.array(at))) @ w > t).astype(np.int64)
                for k in (0, 1):
                    s[k, at] = side[:, k * need:(k + 1) * need] @ (1 << np.arange(need, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s[0]), pa.array(s[1])], [*batch.schema.names, "s0", "s1"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    return nodes.mapInArrow(run, schema + ", s0 long, s1 long")


def _dealt(nodes: DataFrame, side: str, name: str) -> DataFrame:
    """Adds the block ``name``: all nodes of one signature, or a hashed part of them."""
    parts = nodes.groupBy("dim", side).agg(F.ceil(F.count("*") / F.lit(1.25 * BLOCK)).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("d1"), F.col("parts"))
    return nodes.join(parts, ["dim", side]).withColumn(
        name, F.pmod(F.xxhash64("dim", F.lit(side), side, part), F.lit(1 << (63 - INDEX)))).drop("parts")


def _homes(nodes: DataFrame, largest: float) -> DataFrame:
    """Numbered nodes with their codes and the best of their block."""
    schema = "dim int, d0 long, d1 long, nid long, s1 long, code binary, ids array<long>, scores array<float>"

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by([("d0", "ascending"), ("d1", "ascending")])
        x = _floats(group["x"]) / np.sqrt(largest)
        x = np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1, keepdims=True)))]).astype(np.float16)
        nid = (np.int64(group["home"][0].as_py()) << INDEX) + np.arange(len(x))
        near, score = best_in_block(x.astype(np.float32), DEGREE)
        return pa.table([group["dim"], group["d0"], group["d1"], pa.array(nid), group["s1"], pa.array([v.tobytes() for v in x], pa.binary()),
                         pa.array([nid[v[v >= 0]] for v in near], pa.list_(pa.int64())),
                         pa.array([s[v >= 0] for v, s in zip(near, score)], pa.list_(pa.float32()))],
                        names=["dim", "d0", "d1", "nid", "s1", "code", "ids", "scores"])

    return nodes.select("dim", "d0", "d1", "x", "s1", "home").groupBy("home").applyInArrow(run, schema)


def _second(nodes: DataFrame) -> DataFrame:
    """Candidates from the blocks of the second set of hyperplanes."""
    def run(group: pa.Table) -> pa.Table:
        nid = group["nid"].to_numpy()
        near, score = best_in_block(_codes(group["code"]), FRESH)
        a, b = np.nonzero(near >= 0)
        other = nid[near[a, b]]
        ok = (other >> INDEX) != (nid[a] >> INDEX)  # what shares the home is known there
        return _table(CANDIDATES, (nid[a] >> INDEX)[ok], nid[a][ok], other[ok], score[a, b][ok])

    return _dealt(nodes, "s1", "block").select("block", "nid", "code").groupBy("block").applyInArrow(run, CANDIDATES)


def _padded(lists: pa.Array, fill, width: int) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.full((len(size), width), fill)
    out[np.arange(width) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _merged(lists: DataFrame, candidates: DataFrame, round_: int) -> DataFrame:
    """Lists with improving candidates in, and what the next round draws of them."""
    def run(own: pa.Table, new: pa.Table) -> pa.Table:
        if not own.num_rows:
            return _table(LISTS, [], [], [], [], [])
        own = own.combine_chunks()
        nid = own["nid"].to_numpy()
        order = np.argsort(nid)
        ids, score, state = _padded(own["ids"], np.int64(-1), DEGREE), _padded(own["scores"], np.float32(-np.inf), DEGREE), _padded(own["state"], np.int8(0), DEGREE)
        row, col = np.nonzero(ids >= 0)
        extra = order[np.searchsorted(nid[order], new["nid"].to_numpy())]
        owner = np.concatenate([row, extra])
        item = np.concatenate([ids[row, col], new["item"].to_numpy()])
        # a known neighbour's own entry comes before the same one found again
        value = np.concatenate([score[row, col], new["score"].to_numpy()])
        flag = np.concatenate([np.where(state[row, col] == NEW, NEW, PLAIN), np.full(len(extra), NEW)]).astype(np.int8)
        known = np.unique(np.stack([row, ids[row, col]], 1), axis=0, return_index=True)[1] if len(row) else np.zeros(0, np.int64)
        take = np.concatenate([known, np.arange(len(row), len(owner))])
        take = take[top_of(owner[take], item[take], np.where(take < len(row), np.nextafter(value[take], np.float32(9)), value[take]), DEGREE)]
        owner, item, value, flag = owner[take], item[take], value[take], flag[take]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
        ids, score, state = np.full_like(ids, -1), np.full_like(score, -np.inf), np.zeros_like(state)
        ids[owner, rank], score[owner, rank], state[owner, rank] = item, value, flag
        new_ones = pick(ids, (state == NEW) & (ids >= 0), nid, FRESH, round_)
        old_ones = pick(ids, (state == PLAIN) & (ids >= 0), nid, OLD, round_)
        state[new_ones], state[old_ones] = DRAWN_NEW, DRAWN_OLD
        full = ids >= 0
        return _table(LISTS, np.asarray(own["home"]), nid, [v[f] for v, f in zip(ids, full)], [v[f] for v, f in zip(score, full)], [v[f] for v, f in zip(state, full)])

    return lists.select("home", "nid", "ids", "scores", "state").groupBy("home").cogroup(
        candidates.select("home", "nid", "item", "score").groupBy("home")).applyInArrow(run, LISTS)


def _round(lists: DataFrame, codes: DataFrame, round_: int) -> DataFrame:
    """Candidates from the neighbours of neighbours of every node."""
    drawn = lists.select("nid", F.explode(F.arrays_zip("ids", "state")).alias("e")).filter(F.col("e.state") >= DRAWN_NEW).select(
        "nid", F.col("e.ids").alias("id"), (F.col("e.state") == DRAWN_NEW).alias("fresh"))
    # a node that very many lists hold is drawn by a hash sample of them, as large as its own draw
    back = Window.partitionBy("id", "fresh").orderBy(F.xxhash64(F.lit(round_), "nid"), "nid")
    drawn = drawn.withColumn("rank", F.row_number().over(back)).filter(F.col("rank") <= FRESH).filter(
        F.col("fresh") | (F.col("rank") <= OLD)).select("nid", "id", "fresh")
    drawn = store(drawn, "drawn")
    home = lambda c: F.shiftright(c, INDEX).alias("home")
    member = drawn.select(home("nid"), F.col("nid").alias("at"), "id", "fresh").unionByName(
        drawn.select(home("id"), F.col("id").alias("at"), F.col("nid").alias("id"), "fresh"))
    asks = store(member.select("home", F.col("id").alias("nid")).distinct(), "asks")
    worst = lists.select("nid", F.when(F.size("scores") >= DEGREE, F.element_at("scores", -1)).alias("kth"))
    told = asks.join(codes.join(worst, "nid"), "nid").select("home", "nid", "code", "kth")

    def run(member: pa.Table, told: pa.Table) -> pa.Table:
        ids = told["nid"].to_numpy()
        order = np.argsort(ids)
        kth = told["kth"].combine_chunks() if isinstance(told["kth"], pa.ChunkedArray) else told["kth"]
        kth = np.nan_to_num(kth.to_numpy(zero_copy_only=False).astype(np.float32), nan=-np.inf, neginf=-np.inf)[order]
        place = np.searchsorted(ids[order], member["id"].to_numpy())
        a, b, score = local_join(_codes(told["code"])[order], kth, member["at"].to_numpy(), place, member["fresh"].to_numpy(zero_copy_only=False), SENT)
        a, b = ids[order][a], ids[order][b]
        return _table(CANDIDATES, a >> INDEX, a, b, score)

    return member.groupBy("home").cogroup(told.groupBy("home")).applyInArrow(run, CANDIDATES)


def neighbour_graph(nodes: DataFrame, rounds: int = 5, enough: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """Numbered nodes ``nid, dim, d0, d1``, and their neighbours ``nid, ids`` in both directions."""
    largest = nodes.select(F.max(F.expr("aggregate(x, 0D, (a, v) -> a + CAST(v AS DOUBLE) * CAST(v AS DOUBLE))"))).first()[0]
    homes = store(_homes(_dealt(_signed(nodes, 3), "s0", "home"), largest or 1.0), "homes")
    lists = homes.select(F.shiftright("nid", INDEX).alias("home"), "nid", "ids", "scores", F.transform("ids", lambda _: F.lit(NEW).cast("byte")).alias("state"))
    candidates = store(_second(homes), "candidates")
    entries = DEGREE * homes.count()
    for round_ in range(rounds):
        lists = store(_merged(lists, candidates, round_), "lists")
        if round_ and candidates.count() <= enough * entries:
            break
        candidates = store(_round(lists, homes.select("nid", "code"), round_), "candidates")
    links = lists.select("nid", F.explode("ids").alias("id"))
    back = Window.partitionBy("id").orderBy(F.xxhash64("nid"), "nid")
    backward = links.withColumn("rank", F.row_number().over(back)).filter(F.col("rank") <= DEGREE).select(F.col("id").alias("nid"), F.col("nid").alias("id"))
    graph = links.unionByName(backward).groupBy("nid").agg(F.collect_set("id").alias("ids"))
    return homes.select("nid", "dim", "d0", "d1"), store(graph, "graph")


BEAMS = "home long, part int, nid long, code binary, ids array<long>, scores array<float>, state array<byte>"


def _advance(ids: np.ndarray, score: np.ndarray, state: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Beams in order of falling score, and the first nodes not yet expanded marked for the next hop."""
    order = np.argsort(-score, 1, kind="stable")[:, :beam]
    at = np.arange(len(ids))[:, None]
    ids, score, state = ids[at, order], score[at, order], state[at, order]
    state[state == DRAWN_NEW] = PLAIN
    waiting = (state == NEW) & (ids >= 0)
    state[waiting & (np.cumsum(waiting, 1) <= EXPANDED)] = DRAWN_NEW
    return ids, score, state


def _beams(table: pa.Table, ids: np.ndarray, score: np.ndarray, state: np.ndarray, part: np.ndarray) -> pa.Table:
    full = ids >= 0
    return _table(BEAMS, np.asarray(table["home"]), part, np.asarray(table["nid"]), table["code"].to_pylist(),
                  [v[f] for v, f in zip(ids, full)], [v[f] for v, f in zip(score, full)], [v[f] for v, f in zip(state, full)])


def _meet(q: np.ndarray, x: np.ndarray, nid: np.ndarray, ids: np.ndarray, score: np.ndarray, state: np.ndarray, beam: int,
          step: int = 8192) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Beams with the best of the nodes ``nid`` in."""
    at = np.arange(len(q))[:, None]
    for lo in range(0, len(x), step):
        s = q @ x[lo:lo + step].T
        c = min(beam, s.shape[1])
        top = np.argpartition(-s, c - 1, 1)[:, :c]
        ids, score = np.hstack([ids, nid[lo:lo + step][top]]), np.hstack([score, s[at, top]])
        state = np.hstack([state, np.full(top.shape, NEW, np.int8)])
        best = np.argpartition(-score, min(beam, score.shape[1]) - 1, 1)[:, :beam]
        ids, score, state = ids[at, best], score[at, best], state[at, best]
    return ids, score, state


def _start(nodes: DataFrame, beam: int) -> DataFrame:
    """Beams of the queries from their home blocks."""
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("nid")
        asked = group.filter(group["asked"])
        if not asked.num_rows:
            return _table(BEAMS, *[[]] * 7)
        x, n = _codes(group["code"], np.float32), asked.num_rows
        found = _meet(_codes(asked["code"], np.float32), x, group["nid"].to_numpy(), np.zeros((n, 0), np.int64), np.zeros((n, 0), np.float32), np.zeros((n, 0), np.int8), beam)
        return _beams(asked, *_advance(*found, beam), np.arange(n) * -(-n // QUERIES) // n)

    return nodes.select(F.shiftright("nid", INDEX).alias("home"), "nid", "code", "asked").groupBy("home").applyInArrow(run, BEAMS)


def _hop(beams: DataFrame, asks: DataFrame, nodes: DataFrame, beam: int) -> DataFrame:
    """Beams after the nodes asked for have been scored by all queries of their group."""
    def run(own: pa.Table, told: pa.Table) -> pa.Table:
        if not own.num_rows:
            return _table(BEAMS, *[[]] * 7)
        own = own.combine_chunks()
        width = max(1, int(np.max(own["ids"].combine_chunks().value_lengths().to_numpy() if isinstance(own["ids"], pa.ChunkedArray) else own["ids"].value_lengths().to_numpy())))
        ids, score, state = _padded(own["ids"], np.int64(-1), width), _padded(own["scores"], np.float32(-np.inf), width), _padded(own["state"], np.int8(0), width)
        if told.num_rows:
            ids, score, state = _meet(_codes(own["code"], np.float32), _codes(told["code"], np.float32), told["nid"].to_numpy(), ids, score, state, beam)
        return _beams(own, *_advance(ids, score, state, beam), own["part"].to_numpy())

    told = asks.join(nodes.select("nid", "code"), "nid").select("home", "part", "nid", "code")
    return beams.groupBy("home", "part").cogroup(told.groupBy("home", "part")).applyInArrow(run, BEAMS)


def _walk(beams: DataFrame, asked: list[DataFrame], nodes: DataFrame, graph: DataFrame, beam: int) -> DataFrame:
    """Hops until every query has expanded its whole beam. ``asked`` collects what each group has fetched."""
    while True:
        edge = beams.select("home", "part", F.explode(F.arrays_zip("ids", "state")).alias("e")).filter(F.col("e.state") == DRAWN_NEW).select(
            "home", "part", F.col("e.ids").alias("nid")).distinct()
        met = edge.join(graph, "nid").select("home", "part", F.explode("ids").alias("nid")).filter(F.shiftright("nid", INDEX) != F.col("home")).distinct()
        for known in asked:
            met = met.join(known, ["home", "part", "nid"], "left_anti")
        new = store(met, "asked")
        asked.append(new)
        if len(asked) > 3:  # few tables to look into
            whole = asked[0]
            for other in asked[1:]:
                whole = whole.unionByName(other)
            asked[:] = [store(whole, "asked")]
        beams = store(_hop(beams, new, nodes, beam), "beams")
        if not beams.filter(F.array_contains("state", F.lit(DRAWN_NEW).cast("byte"))).select("nid").head(1):
            return beams


DOT = "aggregate(zip_with({}, {}, (a, b) -> CAST(a AS DOUBLE) * CAST(b AS DOUBLE)), 0D, (s, v) -> s + v)"


def _ranked(beams: DataFrame, nodes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the best nodes scored on the original vectors, as ids."""
    top = beams.select("nid", F.explode(F.slice("ids", 1, 2 * k + 2)).alias("id"))
    pairs = top.join(nodes.select(F.col("nid").alias("id"), F.col("x").alias("other"), "members"), "id").join(nodes.select("nid", "x"), "nid")
    scored = pairs.select("nid", "members", F.expr(DOT.format("x", "other")).alias("score"))
    # at most 2k + 2 nodes of at most k + 1 ids; one id more than wanted, as a query is not its own neighbour
    found = scored.groupBy("nid").agg(F.collect_list(F.struct((-F.col("score")).alias("s"), "members")).alias("m"))
    found = found.withColumn("m", F.expr(
        f"slice(sort_array(flatten(transform(m, n -> transform(n.members, v -> struct(n.s AS s, v AS vec_id))))), 1, {2 * k + 2})"))
    asked = queries.join(nodes.select("nid", "dim", "d0", "d1"), ["dim", "d0", "d1"]).select("vec_id", "nid")
    out = asked.join(found, "nid").withColumn("m", F.expr(f"slice(filter(m, e -> e.vec_id <> vec_id), 1, {k})"))
    return out.select(F.col("vec_id").alias("query_id"), F.posexplode("m").alias("p", "e")).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.col("e.vec_id").alias("vec_id"), (-F.col("e.s")).alias("score"))


def measured_recall(found: DataFrame, nodes: DataFrame, queries: DataFrame, k: int, sample: int = 64) -> float:
    """Share of the true neighbours of a hash sample of ``sample`` queries that were found, by score, against all nodes."""
    picked = queries.join(nodes.select("dim", "d0", "d1", "x"), ["dim", "d0", "d1"]).orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    if not picked:
        return 1.0
    asked = [(int(r["vec_id"]), np.array(r["x"], np.float64)) for r in picked]

    def run(batches):
        for batch in batches:
            members = [m.as_py() for m in batch.column("members")]
            dim, q, s = batch.column("dim").to_numpy(), [], []
            for vec_id, x in asked:
                at = np.flatnonzero(dim == len(x))
                if len(at):
                    score = _floats(batch.column("x").take(pa.array(at))) @ x
                    order = np.argsort(-score, kind="stable")[:k + 1]
                    best = [(v, float(score[i])) for i in order for v in members[at[i]] if v != vec_id][:k]
                    q += [vec_id] * len(best)
                    s += [v for _, v in best]
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(s, pa.float64())], ["query_id", "score"])

    truth = nodes.select("dim", "x", "members").mapInArrow(run, "query_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc())
    truth = truth.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).groupBy("query_id").agg(
        F.count("*").alias("want"), F.min("score").alias("least"))
    have = found.filter(F.col("query_id").isin([v for v, _ in asked])).join(truth, "query_id").groupBy("query_id", "want").agg(
        F.count_if(F.col("score") >= F.col("least") - 1e-12 * F.abs("least")).alias("have"))
    shares = {r["query_id"]: min(r["have"], r["want"]) / r["want"] for r in have.collect()}
    told = truth.select("query_id").collect()  # a query without any other row has nothing to find
    return sum(shares.get(r["query_id"], 0.0) for r in told) / max(1, len(told)) if told else 1.0


def nearest(vectors: DataFrame, queries: Column, k: int = 20, beam: int = 128, min_recall: float = 0.92, attempts: int = 3) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest rows of every row that ``queries`` (a condition) chooses."""
    beam = max(beam, 2 * k + 2)
    held, asking = nodes_of(vectors, queries, k + 1)
    held, asking = store(held, "held"), store(asking, "asking")
    numbers, graph = neighbour_graph(held.select("dim", "d0", "d1", "x"))
    nodes = held.join(numbers, ["dim", "d0", "d1"])

    def pack(batches):
        for batch in batches:
            x = batch.column("x")
            size, flat = x.value_lengths().to_numpy(), x.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
            cut = np.append(0, np.cumsum(size))
            code = pa.array([flat[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, code], [*batch.schema.names, "code"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    nodes = store(nodes.mapInArrow(pack, schema + ", code binary"), "numbered")
    beams, asked = store(_start(nodes, beam), "beams"), []
    for _ in range(attempts):
        beams = _walk(beams, asked, nodes, graph, beam)
        found = store(_ranked(beams, nodes, asking, k), "found")
        recall = measured_recall(found, nodes, asking, k)
        if recall >= min_recall:
            return found
        beam *= 2
    raise RuntimeError(f"recall {recall:.3f} stayed below {min_recall} with a beam of {beam // 2}")
