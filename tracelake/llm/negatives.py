"""Hard negatives by a vertical scan of vector columns.

For each anchor: the ``positives`` best other rows of its label, and for each of those the
``negatives`` best rows of other labels whose score is between ``low`` and ``high`` hundredths
of the positive's. Scores are inner products of whole numbers, so all comparisons are exact.

1. Rows are dealt by hash into blocks of about ``block`` rows. A block is one row that keeps
   every dimension as a column of its own, with the dimension's least and greatest value.
2. An anchor reads the columns of a block in descending magnitude of its own components and
   adds up partial scores. What the unread columns can still add lies between sums of their
   least and greatest contributions; rows that can reach no window, or not its best ones,
   leave the bitmap of candidates. What is left after the last column has exact scores.
3. Blocks of anchors meet blocks of rows by an equi-join on (anchor block, slice). A task goes
   through the blocks of a slice one by one and carries each anchor's best rows along, so later
   blocks are cut more sharply, and it returns a few rows per anchor.

The work is anchors times rows, as every anchor ranks all rows; no pair is written but the best.

Defined results: rows without id, label or vector, or with a null or non-finite component, take
no part; rows are told apart by position, so a repeated row is another row (a copy of an anchor
can be its positive, and is an anchor itself); ties go to the smaller id; vectors of other
length are never compared; an anchor without positives, or a positive whose window is empty
(as below zero), gives no rows; an empty table gives no rows; other columns are not read.
Components are whole numbers of 64 bits; a score beyond 64 bits raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm.stored import store

STEP = 8                # columns read between two looks at the bitmap
EXACT = float(1 << 53)  # whole numbers up to here are exact as doubles
KEY = ["dim", "ablock", "slice"]
PACKED = "dim int, block int, kind string, n int, ids binary, seqs binary, labels array<string>, data binary, least binary, most binary"


def integer_rows(vectors: DataFrame, scale: int) -> DataFrame:
    """Usable rows: ``seq, vec_id, label, dim, vector`` with ``floor(scale * x)`` in place of x."""
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), x.alias("x"))
    usable = F.expr("""vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL
        AND NOT exists(x, v -> v IS NULL OR isnan(v) OR abs(v) = double('Infinity'))""")
    return rows.filter(usable).select(F.monotonically_increasing_id().alias("seq"), "vec_id", "label", F.size("x").alias("dim"),
                                      F.transform("x", lambda v: F.floor(v * F.lit(float(scale)))).alias("vector"))


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in the smallest type that holds them."""
    for kind in (np.int16, np.int32):
        if not x.size or (x.min() >= np.iinfo(kind).min and x.max() <= np.iinfo(kind).max):
            return x.astype(kind)
    return x


def _pack(group: pa.Table) -> pa.Table:
    """One block as one row, dimension by dimension."""
    group = group.combine_chunks()
    n, dim = group.num_rows, group["dim"][0].as_py()
    flat = group["vector"].combine_chunks().flatten() if isinstance(group["vector"], pa.ChunkedArray) else group["vector"].flatten()
    data = _narrow(np.ascontiguousarray(flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, dim).T))
    return pa.table({
        "dim": pa.array([dim], pa.int32()), "block": group["block"][:1].cast(pa.int32()), "kind": [data.dtype.name], "n": pa.array([n], pa.int32()),
        "ids": [group["vec_id"].to_numpy().astype(np.int64).tobytes()], "seqs": [group["seq"].to_numpy().astype(np.int64).tobytes()],
        "labels": pa.array([group["label"].to_pylist()], pa.list_(pa.string())), "data": [data.tobytes()],
        "least": [data.min(1).tobytes() if dim else b""], "most": [data.max(1).tobytes() if dim else b""]})


def columns_of(rows: DataFrame, blocks: Column) -> DataFrame:
    """Blocks of ``rows``, of which there are ``blocks`` per dimension."""
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("seq"), blocks).cast("int"))
    return dealt.select("dim", "block", "seq", "vec_id", "label", "vector").groupBy("dim", "block").applyInArrow(_pack, PACKED)


def vertical(columns: np.ndarray, least: np.ndarray, most: np.ndarray, q: np.ndarray, alive: np.ndarray,
             low: list, high: list, kth: list, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows ``alive`` of a block those that may be among the ``k`` best of a window, and their scores.

    ``kth`` is what a row has to reach in each window by what is known from other blocks.
    """
    order = np.argsort(-np.abs(q), kind="stable")
    a, b = q[order] * least[order], q[order] * most[order]
    zero = a[:0].sum()
    above = np.append(np.cumsum(np.maximum(a, b)[::-1])[::-1], zero)
    below = np.append(np.cumsum(np.minimum(a, b)[::-1])[::-1], zero)
    score = np.zeros(len(alive), columns.dtype)
    for start in range(0, len(order), STEP):
        read = order[start:start + STEP]
        part = columns[read]
        score = score + q[read] @ (part if len(alive) == part.shape[1] else part[:, alive])
        rest = min(start + STEP, len(order))
        top, bottom = score + above[rest], score + below[rest]
        keep = np.zeros(len(alive), bool)
        for lo, hi, least_score in zip(low, high, kth):
            sure = bottom[(bottom >= lo) & (top <= hi)]
            if len(sure) >= k:  # k rows of this block are certain to lie in the window
                least_score = max(least_score, np.partition(sure, len(sure) - k)[len(sure) - k])
            keep |= (top >= max(lo, least_score)) & (bottom <= hi)
        alive, score = alive[keep], score[keep]
        if not len(alive):
            break
    return alive, score


class _Slice:
    """The best rows of each anchor of a block, while its task goes through a slice's blocks."""

    def __init__(self, row: dict, k: int, same: bool):
        self.k, self.same, self.n, self.dim = k, same, row["a_n"], row["dim"]
        self.q = np.frombuffer(row["a_data"], row["a_kind"]).reshape(self.dim, self.n).T
        self.ids, self.seqs = np.frombuffer(row["a_ids"], np.int64), np.frombuffer(row["a_seqs"], np.int64)
        self.labels, self.windows = row["a_labels"], row["windows"]
        self.best = [[[] for _ in self._bounds(i)[0]] for i in range(self.n)]

    def _bounds(self, i: int) -> tuple[list, list]:
        if self.windows is None:
            return [-np.inf], [np.inf]
        w = self.windows[str(self.seqs[i])]
        return [x["lo"] for x in w], [x["hi"] for x in w]

    def add(self, row: dict) -> None:
        n = row["n"]
        data = np.frombuffer(row["data"], row["kind"]).reshape(self.dim, n)
        least, most = np.frombuffer(row["least"], row["kind"]), np.frombuffer(row["most"], row["kind"])
        ids, seqs = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["seqs"], np.int64)
        top = [max([abs(int(v)) for v in x.ravel()[[x.argmin(), x.argmax()]]], default=0) if x.size else 0 for x in (data, self.q)]
        kind = np.float64 if top[0] * top[1] * max(self.dim, 1) < EXACT else object  # exact either way
        exact = (lambda x: x.astype(kind)) if kind is np.float64 else (lambda x: np.array(x.tolist(), object).reshape(x.shape))
        data, least, most, q = exact(data), exact(least), exact(most), exact(self.q)
        codes = {x: i for i, x in enumerate(dict.fromkeys(row["labels"]))}
        code = np.array([codes[x] for x in row["labels"]], np.int64)
        for i in range(self.n):
            low, high = self._bounds(i)
            own = code == codes.get(self.labels[i], -1)
            alive = np.flatnonzero(own & (seqs != self.seqs[i])) if self.same else np.flatnonzero(~own)
            kth = [found[-1][0] if len(found) == self.k else -np.inf for found in self.best[i]]
            alive, score = vertical(data, least, most, q[i], alive, low, high, kth, self.k)
            for w, (lo, hi) in enumerate(zip(low, high)):
                inside = np.flatnonzero((score >= max(lo, kth[w])) & (score <= hi))
                if len(inside) > self.k:
                    cut = np.partition(score[inside], len(inside) - self.k)[len(inside) - self.k]
                    inside = inside[score[inside] >= cut]
                if len(inside):
                    new = [(int(score[j]), int(ids[alive[j]]), int(seqs[alive[j]])) for j in inside]
                    self.best[i][w] = sorted(self.best[i][w] + new, key=lambda t: (-t[0], t[1], t[2]))[:self.k]

    def rows(self) -> Iterator[tuple]:
        for i, found in enumerate(self.best):
            for w, best in enumerate(found):
                for score, vec_id, seq in best:
                    yield int(self.seqs[i]), int(self.ids[i]), w, vec_id, seq, score


def _scan(pairs: DataFrame, k: int, same: bool) -> DataFrame:
    """``aseq, anchor_id, part, vec_id, seq, score``: the best rows per anchor, window and slice."""
    names = ["aseq", "anchor_id", "part", "vec_id", "seq", "score"]

    def told(held: _Slice) -> Iterator[pa.RecordBatch]:
        cells = list(zip(*held.rows())) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "part" else pa.int64()) for n, c in zip(names, cells)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                key = tuple(row[c] for c in KEY)
                if key != at:
                    if held is not None:
                        yield from told(held)
                    row["windows"] = None if row["windows"] is None else dict(row["windows"])
                    at, held = key, _Slice(row, k, same)
                held.add(row)
        if held is not None:
            yield from told(held)

    return pairs.sortWithinPartitions(*KEY).mapInArrow(run, "aseq long, anchor_id long, part int, vec_id long, seq long, score long")


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` best rows per key; Spark applies the limit before the shuffle too."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id", "seq")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         scale: int = 256, block: int = 4096, anchor_block: int = 1024) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of the rows ``anchors`` (a condition on
    ``vec_id`` and ``label``)."""
    rows = store(integer_rows(vectors, scale), "vectors")
    chosen = F.coalesce(anchors, F.lit(False))
    sizes = rows.groupBy("dim").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("nc"),
                                    F.ceil(F.count_if(chosen) / F.lit(anchor_block)).cast("int").alias("na")).filter("na > 0")
    # many anchor blocks give tasks enough; of few, each is dealt over slices of the rows
    tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
    sizes = store(sizes.withColumn("slices", F.least("nc", F.ceil(F.lit(tasks) / F.col("na")).cast("int"))), "sizes")
    columns = store(columns_of(rows.join(sizes, "dim"), F.col("nc")), "columns")
    told = columns.join(sizes, "dim").withColumn("ablock", F.explode(F.sequence(F.lit(0), F.col("na") - 1))).withColumn(
        "slice", F.pmod("block", "slices")).drop("nc", "na", "slices", "block")
    names = ["n", "kind", "ids", "seqs", "labels", "data"]

    def pairs(asked: DataFrame) -> DataFrame:
        asks = asked.join(sizes, "dim").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        return told.join(asks.select("dim", F.col("block").alias("ablock"), "slice", "windows", *[F.col(c).alias(f"a_{c}") for c in names]), KEY)

    some = rows.filter(chosen).join(sizes, "dim")
    first = columns_of(some, F.col("na")).withColumn("windows", F.lit(None).cast("map<string,array<struct<part:int,lo:long,hi:long>>>"))
    near = _best(_scan(pairs(store(first, "anchors")), positives, same=True), ["aseq"], positives)
    near = store(near.select("aseq", "anchor_id", (F.col("rank") - 1).alias("part"), F.col("vec_id").alias("positive_id"),
                             F.col("score").alias("positive_score")), "positives")

    # a window per positive, in the order of the positives; of an anchor block these are few numbers
    windows = near.groupBy("aseq").agg(F.sort_array(F.collect_list(F.struct(
        "part", F.expr(f"CAST(ceil(CAST(positive_score AS DECIMAL(38,0)) * {low} / 100) AS LONG)").alias("lo"),
        F.expr(f"CAST(floor(CAST(positive_score AS DECIMAL(38,0)) * {high} / 100) AS LONG)").alias("hi")))).alias("w"))
    some = some.join(windows, some["seq"] == windows["aseq"]).drop("aseq")
    by_block = some.groupBy("dim", F.pmod(F.xxhash64("seq"), F.col("na")).cast("int").alias("block")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("seq").cast("string"), "w"))).alias("windows"))
    second = store(columns_of(some, F.col("na")).join(by_block, ["dim", "block"]), "windows")
    far = _best(_scan(pairs(second), negatives, same=False), ["aseq", "part"], negatives)
    return far.join(near.drop("anchor_id"), ["aseq", "part"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
