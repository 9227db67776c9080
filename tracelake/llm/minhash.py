"""MinHash near-duplicates with sequential Bayesian verification.

1. ``sketch``: one pass over the texts gives the set size, a 128-bit set digest and a MinHash
   signature per document. Documents of one digest are one class, stood for by the smallest id.
2. ``members``: classes that share a band of their signature with another class.
3. Star pairs (class, smallest class of its bucket) are compared in batches of the signature;
   a pair whose posterior probability of reaching the threshold falls below ``miss`` is
   dropped. Survivors are verified on their full sets, best guess of each class first, the
   rest only where both ends are still in different components.
4. Buckets whose members are then still in different components are compared in full, block
   against block, again only across components, and keep a forest of what belongs together.
   So no link between components is lost to the star, while a group of thousands of copies
   gives a number of links linear in its size.

Chances: a pair at the threshold is missed by all bands with probability
``(1 - 0.8 ** ROWS) ** BANDS`` (5e-8) and by pruning with ``miss`` (1e-6).

Defined results: null or empty texts have no shingle and link with nothing; rows without id
link with nothing, have no component and are kept; rows that repeat an id and a text are
classed together; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm.blocks import BASE, LOWER, SPACE, Hashes, Texts, blocks, grams_of, mix
from tracelake.llm.components import components
from tracelake.llm.skew import hot_keys, meet
from tracelake.llm.stored import store

BANDS, ROWS = 32, 4
SIZE = BANDS * ROWS
BATCH = 16
MISS = 1e-6
#: A block where signatures are compared in one task has so many rows, one of full sets so many shingles.
SIGNATURE_BLOCK, SET_BLOCK = 1024, 1 << 17
_MULTIPLY = (mix(np.arange(1, SIZE + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_ADD = (mix(np.arange(1001, SIZE + 1001, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def shingle_sets(texts: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, and each row's first."""
    lowered = Texts(LOWER[texts.data], texts.offsets)
    words = lowered.runs(~SPACE[lowered.data])
    h = Hashes(lowered.data).of(words.start, words.end)
    gram, _, first = grams_of(h, words.first, k)
    count = words.per_row
    short = np.flatnonzero((count > 0) & (count < k))
    size = np.diff(first)
    size[short] = 1
    begins = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=begins[1:])
    out = np.empty(begins[-1], np.uint64)
    whole = np.ones(len(out), bool)
    whole[begins[short]] = False
    out[whole] = gram
    for r in short.tolist():  # fewer words than a shingle: the sequence itself
        x = np.uint64(count[r])
        for w in h[words.first[r]:words.first[r + 1]]:
            x = np.uint64((int(x) * int(BASE) + int(w) + 1) & 0xFFFFFFFFFFFFFFFF)
        out[begins[r]] = mix(np.array([x], np.uint64))[0]
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        out[a:b].sort()
    row = np.repeat(np.arange(len(size)), size)
    fresh = np.ones(len(out), bool)
    fresh[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    return out[fresh], np.searchsorted(row[fresh], np.arange(len(size) + 1))


def signatures(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``SIZE`` minima for each non-empty set."""
    x = (values >> np.uint64(32)).astype(np.uint32)
    at = first[:-1][np.diff(first) > 0]
    out = np.empty((len(at), SIZE), np.uint32)
    for i in range(SIZE):
        out[:, i] = np.minimum.reduceat(x * _MULTIPLY[i] + _ADD[i], at) if len(at) else 0
    return out


def _digests(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set that do not depend on an order; 0 for an empty set."""
    out = []
    for salt in (0x1F83D9AB, 0x5BE0CD19):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values ^ np.uint64(salt << 20)), out=total[1:])
        out.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
    return out[0], out[1]


def sketch(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, d0, d1, signature`` of every row; the signature of an empty set is null."""
    schema = "doc_id long, text_key long, n_shingles long, d0 long, d1 long, signature binary"

    def run(batches):
        for batch in batches:
            for rows, texts in blocks(batch):
                values, first = shingle_sets(texts, k)
                size = np.diff(first)
                sig = signatures(values, first)
                at = np.cumsum(size > 0) - 1
                body = [sig[i].tobytes() if n else None for i, n in zip(at.tolist(), size.tolist())]
                d0, d1 = _digests(values, first)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(2), pa.array(size), pa.array(d0), pa.array(d1), pa.array(body, pa.binary())],
                    ["doc_id", "text_key", "n_shingles", "d0", "d1", "signature"])

    return _texts(docs).withColumn("text_key", text_key("text")).mapInArrow(run, schema)


def text_key(text: str) -> Column:
    """What tells two texts of one id apart."""
    return F.xxhash64(F.col(text).cast("string"))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _signature_rows(column: pa.Array) -> np.ndarray:
    t = Texts.of(column)
    return t.data.view(np.uint32).reshape(-1, SIZE)


def members(classes: DataFrame) -> DataFrame:
    """``bucket, pivot, node`` for every class that shares a band with a smaller or larger one."""
    def run(batches):
        for b in batches:
            node, sig = b.column(0).to_numpy(), _signature_rows(b.column(1))
            key = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(sig), 0) * np.uint64(0x9E3779B97F4A7C15)
            for j in range(ROWS):
                key = mix(key ^ sig[:, j::ROWS].astype(np.uint64)) * BASE
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64).ravel()), pa.array(np.repeat(node, BANDS))], ["bucket", "node"])

    bands = classes.select("node", "signature").mapInArrow(run, "bucket long, node long")
    pivots = bands.groupBy("bucket").agg(F.min("node").alias("pivot"), F.max("node").alias("_top"))
    return bands.join(pivots.filter("pivot <> _top").drop("_top"), "bucket").select("bucket", "pivot", "node")


def least_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """After n compared values at least m must agree, else ``P(similarity >= threshold) < miss``.

    With a uniform prior the posterior after m of n is Beta(m + 1, n - m + 1), whose upper
    tail is the chance of at most m successes in n + 1 draws of probability ``threshold``.
    """
    out = []
    for n in range(BATCH, SIZE + 1, BATCH):
        tail, m = 0.0, 0
        while True:
            tail += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def posterior_filter(left: np.ndarray, right: np.ndarray, bounds: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of row pairs that no batch could rule out, and their agreements over all values."""
    alive = np.arange(len(left))
    agree = np.zeros(len(left), np.int64)
    for n, least in bounds:
        agree += (left[alive, n - BATCH:n] == right[alive, n - BATCH:n]).sum(1)
        stay = agree >= least
        alive, agree = alive[stay], agree[stay]
    return alive, agree


def _pruned(pairs: DataFrame, classes: DataFrame, threshold: float, bound: int) -> DataFrame:
    """``a, b, agree`` of the pairs that survive the sequential comparison."""
    bounds = least_matches(threshold)
    side = lambda c: classes.select(F.col("node").alias(c), F.col("n_shingles").alias(f"n{c}"), F.col("signature").alias(f"s{c}"))
    joined = meet(pairs, side("a"), "a", hot_keys(pairs, "a", bound)).join(side("b"), "b").select("a", "b", "na", "nb", "sa", "sb")

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                b = batch.slice(lo, 4096)
                small, large = np.sort(np.stack([b.column(2).to_numpy(), b.column(3).to_numpy()]), 0)
                near = np.flatnonzero(small >= threshold * large - 1e-9)
                at, agree = posterior_filter(_signature_rows(b.column(4))[near], _signature_rows(b.column(5))[near], bounds)
                keep = pa.array(near[at])
                yield pa.RecordBatch.from_arrays([b.column(0).take(keep), b.column(1).take(keep), pa.array(agree)], ["a", "b", "agree"])

    return joined.mapInArrow(run, "a long, b long, agree long")


def _sets(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """``node, shingles`` (sorted distinct 64-bit values) of the classes in ``nodes`` (node, d0)."""
    rows = _texts(docs).join(nodes, F.col("doc_id") == F.col("node")).select("node", "d0", "text")

    def run(batches):
        for batch in batches:
            for b, texts in blocks(batch):
                values, first = shingle_sets(texts, k)
                own = _digests(values, first)[0] == b.column(1).to_numpy()
                body = [values[x:y].tobytes() for x, y in zip(first[:-1].tolist(), first[1:].tolist())]
                keep = pa.array(np.flatnonzero(own))
                yield pa.RecordBatch.from_arrays([b.column(0).take(keep), pa.array(body, pa.binary()).take(keep)], ["node", "shingles"])

    return rows.mapInArrow(run, "node long, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float, bound: int) -> DataFrame:
    """Pairs whose full sets reach the threshold (compared in whole percents)."""
    percent = round(100 * threshold)
    side = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}"))
    pairs = pairs.select("a", "b")
    joined = meet(pairs, side("a"), "a", hot_keys(pairs, "a", bound)).join(side("b"), "b").select("a", "b", "sa", "sb")

    def run(batches):
        for batch in batches:
            left, right = Texts.of(batch.column(2)), Texts.of(batch.column(3))
            lv, rv = left.data.view(np.uint64), right.data.view(np.uint64)
            lo, ro = left.offsets // 8, right.offsets // 8
            ok = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = lv[lo[i]:lo[i + 1]], rv[ro[i]:ro[i + 1]]
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                ok[i] = 100 * same >= percent * (len(both) - same)
            keep = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], ["a", "b"])

    return joined.mapInArrow(run, "a long, b long")


def _labelled(rows: DataFrame, labels: DataFrame, node: str, out: str) -> DataFrame:
    found = labels.select(F.col("node").alias(node), F.col("component").alias("_c"))
    return rows.join(found, node, "left").withColumn(out, F.coalesce("_c", node)).drop("_c")


def _blocked(rows: DataFrame, group: str, weight: str, block: int) -> DataFrame:
    """Deal the members of each group by hash into blocks of about ``block`` in total weight; each member meets every block once, as side ``i`` or ``j``."""
    sizes = rows.groupBy(group).agg(F.ceil(F.sum(F.expr(weight)) / F.lit(block)).cast("int").alias("_n"))
    rows = rows.join(sizes, group)
    own = F.pmod(F.xxhash64("node"), F.col("_n")).cast("int")
    rows = rows.select(group, "node", "label", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("other"))
    return rows.select(group, "node", "label", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def _forest(group: pa.Table, near) -> pa.Table:
    """Links between different labels in one pair of blocks, as a spanning forest.

    ``near(x, ys)`` tells which of the rows ``ys`` are near row ``x``. Pairs whose ends are
    connected already are not tested, so no more links than rows come out.
    """
    node, label, own = (group[c].to_numpy() for c in ("node", "label", "own"))
    i, j = group["i"][0].as_py(), group["j"][0].as_py()
    right = np.flatnonzero(own == j)
    tree = np.arange(len(node))
    links = []
    for x in np.flatnonzero(own == i).tolist():
        y = right if i != j else right[right > x]
        y = y[(tree[y] != tree[x]) & (label[y] != label[x])]
        if len(y):
            y = y[near(x, y)]
            trees, first = np.unique(tree[y], return_index=True)
            links += [(node[x], node[k]) for k in y[first].tolist()]
            tree[np.isin(tree, trees)] = tree[x]
    return pa.table({"a": pa.array([min(p) for p in links], pa.int64()), "b": pa.array([max(p) for p in links], pa.int64())})


def _across(member: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links between components inside buckets that still hold several of them, enough to join what belongs together.

    First the signatures of each bucket are compared across components; what no batch rules
    out is only kept as a forest, whose trees are the groups of rows that may still be linked.
    Then each group is compared on its full sets, once, whatever the number of its buckets.
    """
    bounds, percent = least_matches(threshold), round(100 * threshold)
    rows = _labelled(member.select("bucket", "node"), labels, "node", "label")
    mixed = rows.groupBy("bucket").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).filter("_lo <> _hi")
    rows = store(rows.join(mixed.select("bucket"), "bucket"), "mixed")
    by_bucket = _blocked(rows, "bucket", "1", SIGNATURE_BLOCK).join(classes.select("node", "n_shingles", "signature"), "node")

    def by_signature(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        n, sig = group["n_shingles"].to_numpy(), _signature_rows(group["signature"].chunk(0))

        def near(x, ys):
            fits = np.minimum(n[ys], n[x]) >= threshold * np.maximum(n[ys], n[x]) - 1e-9
            at = np.flatnonzero(fits)
            return at[posterior_filter(np.broadcast_to(sig[x], (len(at), SIZE)), sig[ys[at]], bounds)[0]]

        return _forest(group, near)

    maybe = by_bucket.groupBy("bucket", "i", "j").applyInArrow(by_signature, "a long, b long")
    trees = components(maybe)
    roots = trees.select(F.col("component").alias("node"), "component").distinct()
    trees = trees.unionByName(roots).join(rows.select("node", "label").distinct(), "node").join(classes.select("node", "n_shingles"), "node")
    by_group = _blocked(store(trees, "groups"), "component", "n_shingles", SET_BLOCK).join(sets, "node")

    def by_set(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        t = Texts.of(group["shingles"].chunk(0))
        values, first = t.data.view(np.uint64), t.offsets // 8
        code = np.unique(values, return_inverse=True)[1].astype(np.int32)
        size = np.diff(first)
        marked = np.zeros(code.max() + 1, bool)

        def near(x, ys):
            own = code[first[x]:first[x + 1]]
            marked[own] = True
            length = size[ys]
            begin = np.cumsum(length) - length
            at = np.repeat(first[ys] - begin, length)
            at += np.arange(len(at))
            same = np.add.reduceat(marked[code[at]], begin, dtype=np.int64)
            marked[own] = False
            return 100 * same >= percent * (size[x] + length - same)

        return _forest(group, near)

    return by_group.groupBy("component", "i", "j").applyInArrow(by_set, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_key`` of every row."""
    sketched = store(sketch(docs, shingle), "sketch")
    usable = sketched.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("d0", "d1", "n_shingles").agg(
        F.min(F.struct("doc_id", "signature")).alias("_m"), F.count("*").alias("copies"))
    classes = store(classes.select(F.col("_m.doc_id").alias("node"), "d0", "d1", "n_shingles", "copies",
                                         F.col("_m.signature").alias("signature")), "classes")
    member = store(members(classes), "members")
    stars = member.filter("pivot <> node").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    bound = member.count()   # of a stored table; no fewer than its star pairs
    stars = store(_pruned(stars, classes, threshold, bound), "stars")
    nodes = member.select("node").distinct().join(classes.select("node", "d0"), "node")
    sets = store(_sets(docs, nodes, shingle), "sets")

    best = stars.groupBy("b").agg(F.max(F.struct("agree", "a")).alias("_m")).select(F.col("_m.a").alias("a"), "b")
    links = store(_verified(best, sets, threshold, bound), "verified")
    labels = components(links)
    rest = _labelled(_labelled(stars.select("a", "b"), labels, "a", "la"), labels, "b", "lb").filter("la <> lb")
    rest = rest.join(best, ["a", "b"], "left_anti")
    links = links.unionByName(store(_verified(rest, sets, threshold, bound), "verified"))
    labels = components(links)
    last = store(_across(member, labels, classes, sets, threshold), "verified")
    if last.head(1):
        labels = components(links.unionByName(last))

    of_class = _labelled(classes.select("node", "d0", "d1", "copies"), labels, "node", "component_id")
    of_class = store(of_class.filter("copies > 1 OR component_id <> node").select("d0", "d1", "component_id"), "classes")
    out = sketched.select("doc_id", "text_key", "n_shingles", "d0", "d1").join(of_class, ["d0", "d1"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "text_key")
