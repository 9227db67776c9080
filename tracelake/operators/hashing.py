"""Approximate cosine top-k by stored hash tables and several probes of each.

Every table cuts the vectors by its own random hyperplanes through their mean; the sides are a bucket.
A query looks into its own bucket of every table and into those it misses by the least: the sets of
planes it is nearest to are flipped, cheapest first. Candidates are ranked by their exact cosine. A sample of
queries is compared with ``cosine_topk``; below ``min_recall`` the search runs again with more probes.

The index is a table of ids by (table, part of the buckets, bucket), written once; a search lists and reads
only the parts its probes lie in. A bucket of any size is dealt over salts, so copies do not meet in
one task. Vectors that are null, zero, not finite or of another length than the first are not indexed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.operators.search import TOP_K, cosine_topk, topk_per_query
from tracelake.session import materialize, shared_dir

BUCKET = 64        # vectors that a bucket is meant to have
FLIPS = 10         # planes near a query that may be flipped: 2 ** FLIPS probes at most
PART_BITS = 5      # a table's buckets lie in 2 ** PART_BITS folders
SALT_ROWS = 20_000  # vectors of a bucket that meet a probe in one task


@dataclass(frozen=True)
class HashIndex:
    entries: DataFrame   # tab, part, bucket, salt, vec_id
    vectors: DataFrame   # vec_id, vec
    sizes: DataFrame     # tab, bucket, salts: buckets of more than one salt
    planes: np.ndarray   # table, plane, dimension
    mean: np.ndarray
    vec_id: str

    @property
    def bits(self) -> int:
        return self.planes.shape[1]


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(df: DataFrame, vec: str, dim: int | None = None) -> DataFrame:
    """Rows whose vector is there, finite and not zero, as doubles."""
    df = df.filter(F.col(vec).isNotNull()).withColumn(vec, F.col(vec).cast("array<double>"))
    length = F.aggregate(vec, F.lit(0.0), lambda a, x: a + x * x)
    ok = ~F.exists(vec, lambda x: x.isNull() | F.isnan(x)) & (length > 0) & (length < float("inf"))
    df = df.filter(F.coalesce(ok, F.lit(False)))
    return df if dim is None else df.filter(F.size(vec) == dim)


def build_hash_index(vectors: DataFrame, tables: int = 8, bits: int | None = None, seed: int = 17, *,
                     vec_id: str = "vec_id", vec: str = "embedding") -> HashIndex:
    """Write the hash tables of ``vectors``. ``bits`` planes per table give buckets of about ``BUCKET``."""
    spark = vectors.sparkSession
    first = usable(vectors, vec).select(F.min(F.struct(vec_id, F.size(vec).alias("dim")))["dim"]).first()[0]
    dim = first or 1
    held = materialize(usable(vectors, vec, dim).select(F.col(vec_id).alias("vec_id"), F.col(vec).alias("vec")), "vectors")
    n = held.count()
    bits = max(1, int(np.ceil(np.log2(max(2.0, n / BUCKET))))) if bits is None else bits
    planes = np.random.default_rng(seed).normal(size=(tables, bits, dim))
    # one row per dimension
    unit = held.select(F.transform("vec", lambda x: x / F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, y: a + y * y))).alias("u"))
    means = unit.select(F.posexplode("u").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m")).collect()
    mean = np.zeros(dim)
    for r in means:
        mean[r["i"]] = r["m"]
    weights = 1 << np.arange(bits, dtype=np.int64)

    def hashed(batches):
        for b in batches:
            side = np.einsum("nd,tbd->tnb", _unit(_matrix(b.column("vec"))) - mean, planes, optimize=True) > 0
            bucket = (side @ weights).ravel()
            ids = pa.concat_arrays([b.column("vec_id")] * tables)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(tables, dtype=np.int32), b.num_rows)), pa.array(bucket), ids], ["tab", "bucket", "vec_id"])

    id_type = held.schema["vec_id"].dataType.simpleString()
    rows = held.mapInArrow(hashed, f"tab int, bucket long, vec_id {id_type}")
    part = F.shiftright("bucket", max(0, bits - PART_BITS)).cast("int")
    rows = rows.withColumn("part", part)
    path = shared_dir(spark, "hashes")
    (rows.repartition("tab", "part", F.pmod(F.xxhash64("vec_id"), F.lit(1 + n // (tables * 2_000_000)))).sortWithinPartitions("tab", "part", "bucket")
     .write.partitionBy("tab", "part").parquet(path))
    entries = spark.read.schema(f"bucket long, vec_id {id_type}, tab int, part int").parquet(path)
    sizes = entries.groupBy("tab", "bucket").agg(F.ceil(F.count("*") / F.lit(SALT_ROWS)).cast("int").alias("salts")).filter("salts > 1")
    return HashIndex(entries, held, materialize(sizes, "sizes"), planes, mean, vec_id)


def _probes(asking: DataFrame, index: HashIndex, qid: str, qvec: str, probes: int) -> DataFrame:
    """``qid, tab, bucket``: the buckets that a query looks into, nearest first."""
    planes, mean, bits, tables = index.planes, index.mean, index.bits, len(index.planes)
    flips = min(FLIPS, bits)
    sets = ((np.arange(1 << flips)[:, None] >> np.arange(flips)) & 1).astype(np.float64)
    take = min(probes, len(sets))
    weights = 1 << np.arange(bits, dtype=np.int64)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            away = np.einsum("nd,tbd->tnb", _unit(_matrix(b.column(qvec))) - mean, planes, optimize=True)
            near = np.argsort(np.abs(away), 2)[:, :, :flips]
            margin = np.take_along_axis(away, near, 2) ** 2
            cost = margin @ sets.T
            best = np.argpartition(cost, take - 1, 2)[:, :, :take]
            own = (away > 0) @ weights
            change = np.einsum("tnf,sf->tns", weights[near], sets.astype(np.int64))
            bucket = own[:, :, None] ^ np.take_along_axis(change, best, 2)
            row = np.broadcast_to(np.arange(b.num_rows)[None, :, None], bucket.shape).ravel()
            tab = np.broadcast_to(np.arange(tables, dtype=np.int32)[:, None, None], bucket.shape).ravel()
            yield pa.RecordBatch.from_arrays([b.column(qid).take(pa.array(row)), pa.array(tab), pa.array(bucket.ravel())], [qid, "tab", "bucket"])

    kind = asking.schema[qid].dataType.simpleString()
    return asking.select(qid, qvec).mapInArrow(run, f"`{qid}` {kind}, tab int, bucket long")


def _named(index: HashIndex, wanted: DataFrame) -> DataFrame:
    """Entries in the folders that hold a probed bucket, of which there are at most ``tables * 2 ** PART_BITS``."""
    part = F.shiftright("bucket", max(0, index.bits - PART_BITS)).cast("int")
    there = F.lit(False)
    for r in wanted.groupBy(part.alias("part")).agg(F.collect_set("tab").alias("tabs")).collect():
        there = there | ((F.col("part") == r["part"]) & F.col("tab").isin(r["tabs"]))
    return index.entries.filter(there)


def hashed_candidates(asking: DataFrame, index: HashIndex, probes: int, qid: str, qvec: str) -> DataFrame:
    """``qid, vec_id``: every indexed vector in a probed bucket, once per query."""
    wanted = materialize(_probes(asking, index, qid, qvec, probes), "probes")
    salts = index.sizes
    entries = _named(index, wanted).join(salts, ["tab", "bucket"], "left").withColumn(
        "salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("vec_id"), F.col("salts")).cast("int")))
    asks = wanted.join(salts, ["tab", "bucket"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    return entries.select("tab", "bucket", "salt", "vec_id").join(asks.select(qid, "tab", "bucket", "salt"), ["tab", "bucket", "salt"]).select(qid, "vec_id").distinct()


def _ranked(asking: DataFrame, index: HashIndex, pairs: DataFrame, k: int, qid: str, qvec: str) -> DataFrame:
    both = pairs.join(index.vectors, "vec_id").join(asking.select(qid, qvec), qid).select(qid, "vec_id", "vec", qvec)

    def run(batches):
        for b in batches:
            x, q = _unit(_matrix(b.column("vec"))), _unit(_matrix(b.column(qvec)))
            yield pa.RecordBatch.from_arrays([b.column(qid), b.column("vec_id"), pa.array(np.einsum("nd,nd->n", x, q))], [qid, "vec_id", "similarity"])

    kinds = [both.schema[c].dataType.simpleString() for c in (qid, "vec_id")]
    scored = both.mapInArrow(run, f"`{qid}` {kinds[0]}, vec_id {kinds[1]}, similarity double")
    return topk_per_query(scored, k, qid, "vec_id").withColumnRenamed("vec_id", index.vec_id)


def measured_recall(found: DataFrame, exact: DataFrame, qid: str = "query_id") -> float:
    """Share of the exact results' rows that were found as well, or replaced by equally similar ones."""
    least = exact.groupBy(qid).agg(F.min("similarity").alias("least"), F.count("*").alias("want"))
    have = found.join(least, qid).filter(F.col("similarity") >= F.col("least") - 1e-9).groupBy(qid).agg(F.count("*").alias("have"))
    r = least.join(have, qid, "left").agg(F.sum(F.least("want", F.coalesce("have", F.lit(0)))), F.sum("want")).first()
    return 1.0 if not r[1] else r[0] / r[1]


def hashed_topk(queries: DataFrame, index: HashIndex, k: int = TOP_K, *, probes: int = 16, min_recall: float = 0.9, audit: int = 64,
                qid: str = "query_id", qvec: str = "query_vec") -> DataFrame:
    """(query, vector, similarity, rank_no) of approximately the ``k`` nearest vectors.

    ``audit`` queries, chosen by hash, are compared with the exact search. An error is raised if all probes
    that ``FLIPS`` planes give are not enough for ``min_recall``.
    """
    asking = materialize(usable(queries.select(qid, qvec), qvec, index.planes.shape[2]), "asking")
    sample = asking.orderBy(F.xxhash64(qid), qid).limit(audit)
    exact = materialize(cosine_topk(sample, index.vectors, k, qid=qid, qvec=qvec, vec_id="vec_id", vec="vec"), "exact")
    most = 1 << min(FLIPS, index.bits)
    while True:
        found = materialize(_ranked(asking, index, hashed_candidates(asking, index, probes, qid, qvec), k, qid, qvec), "found")
        recall = measured_recall(found.join(sample.select(qid), qid, "left_semi"), exact, qid)
        if recall >= min_recall:
            return found
        if probes >= most:
            raise RuntimeError(f"recall {recall:.3f} stays below {min_recall} with {most} probes; build the index with more tables or fewer bits")
        probes *= 2
