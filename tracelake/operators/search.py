"""Cosine top-k over a vector table, access-filtered and scoped search, exact cell pruning."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERY_BLOCK = 8_192           # queries held by one task at a time
MAX_QUERY_CELLS = 4_000_000   # numbers in one broadcast query block
TILE_CELLS = 2_000_000        # similarities computed at a time
TOP_K = 5


def _top_schema(vectors: DataFrame, queries: DataFrame, vec_id: str, qid: str) -> T.StructType:
    return T.StructType([
        T.StructField(qid, queries.schema[qid].dataType), T.StructField(vec_id, vectors.schema[vec_id].dataType),
        T.StructField("similarity", T.DoubleType())])


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n == 0.0, 1.0, n)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    return np.asarray(flat.to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)


def query_blocks(queries: DataFrame, qid: str, vec: str, extra: list[str]) -> Iterator[list]:
    """Queries in blocks of at most about ``MAX_QUERY_CELLS`` numbers each. A search has few
    queries; a larger set is read block by block, dealt by hash, whatever their dimension."""
    size = queries.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size(vec)), F.lit(1))).first()
    n_blocks = max(1, -(-size[0] * max(1, size[1]) // MAX_QUERY_CELLS), -(-size[0] // QUERY_BLOCK))
    for b in range(n_blocks):
        part = queries if n_blocks == 1 else queries.filter(F.pmod(F.xxhash64(qid), F.lit(n_blocks)) == b)
        yield part.select(qid, vec, *extra).collect()


def cosine_topk(queries: DataFrame, vectors: DataFrame, k: int = TOP_K, *, qid: str = "query_id",
                qvec: str = "query_vec", vec_id: str = "vec_id", vec: str = "embedding",
                scope: str | None = None, qscope: str | None = None) -> DataFrame:
    """(query, vector, similarity, rank_no): exact cosine top-k.

    A query block of bounded size goes to every task as one matrix. A task multiplies batches
    of vectors with tiles of queries and keeps the k best per query over all its batches, so
    ``k`` rows per query and task are shuffled. With ``scope``/``qscope`` (array<string> of a vector, array<string>
    of a query) a vector counts only for queries that share a tag with it, before ranking.
    """
    schema = _top_schema(vectors, queries, vec_id, qid)
    extra = [qscope] if qscope else []
    parts = []
    for rows in query_blocks(queries, qid, qvec, extra):
        if not rows:
            continue
        bc = queries.sparkSession.sparkContext.broadcast((
            [r[qid] for r in rows], _unit(np.asarray([r[qvec] for r in rows], dtype=np.float64)),
            [tuple(sorted(set(r[qscope]))) for r in rows] if qscope else None))
        parts.append(vectors.select(vec_id, vec, *([scope] if scope else [])).mapInArrow(
            _scorer(bc, k, qid, vec_id, vec, scope, schema), schema))
    if not parts:
        return queries.sparkSession.createDataFrame([], schema).withColumn("rank_no", F.lit(1).cast("long"))
    best = parts[0]
    for p in parts[1:]:
        best = best.unionByName(p)
    return topk_per_query(best, k, qid, vec_id)


class _Best:
    """The ``k`` best rows of every query over all batches of a task; of equal ones the smaller id."""

    def __init__(self, k: int, queries: int):
        self.k, self.least = k, np.full(queries, -np.inf)
        self.query, self.value, self.name = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, object)
        self.limit = 4 * k * queries + 100_000

    def add(self, sims: np.ndarray, names: np.ndarray, first: int) -> None:
        """``sims``: rows x queries from number ``first`` on."""
        k, n = self.k, len(sims)
        least = self.least[first:first + sims.shape[1]]
        if n > k:
            least = np.maximum(least, np.partition(sims, n - k, axis=0)[n - k])
        rows, cols = np.nonzero((sims >= least) & np.isfinite(sims))
        self.query = np.concatenate([self.query, cols + first])
        self.value = np.concatenate([self.value, sims[rows, cols]])
        self.name = np.concatenate([self.name, names[rows]])
        if len(self.query) > self.limit:
            self.cut()

    def cut(self) -> None:
        _, rank = np.unique(self.name, return_inverse=True) if len(self.name) else (None, np.zeros(0, np.int64))
        order = np.lexsort((rank, -self.value, self.query))
        q = self.query[order]
        begin = np.searchsorted(q, q)
        order = order[np.arange(len(q)) - begin < self.k]
        self.query, self.value, self.name = self.query[order], self.value[order], self.name[order]
        full = np.bincount(self.query, minlength=len(self.least)) >= self.k
        worst = np.full(len(self.least), np.inf)
        np.minimum.at(worst, self.query, self.value)
        self.least = np.where(full, worst, -np.inf)


def _rows_by_tag(column: pa.Array) -> dict[str, np.ndarray]:
    """Rows that hold each tag."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    row = np.repeat(np.arange(len(column)), size)
    coded = column.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(code, kind="stable")
    edge = np.searchsorted(code[order], np.arange(len(coded.dictionary) + 1))
    return {t: row[order[edge[i]:edge[i + 1]]] for i, t in enumerate(coded.dictionary.to_pylist())}


def _scorer(bc, k: int, qid: str, vec_id: str, vec: str, scope: str | None, schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def score(batches):
        ids, mat, tags = bc.value
        best = _Best(k, len(ids))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = _unit(_matrix(batch.column(vec), mat.shape[1]))
            names = np.empty(batch.num_rows, object)
            names[:] = batch.column(vec_id).to_pylist()
            held = _rows_by_tag(batch.column(scope)) if scope else None
            step = max(1, TILE_CELLS // len(rows))
            for first in range(0, len(ids), step):
                sims = rows @ mat[first:first + step].T
                if scope:
                    groups: dict[tuple, list[int]] = {}
                    for j, t in enumerate(tags[first:first + step]):
                        groups.setdefault(t, []).append(j)
                    open_ = np.zeros(sims.shape, bool)
                    for t, cols in groups.items():
                        seen = [held[x] for x in t if x in held]
                        if seen:
                            open_[np.ix_(np.unique(np.concatenate(seen)), cols)] = True
                    sims[~open_] = -np.inf
                best.add(sims, names, first)
        best.cut()
        if len(best.query):
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[j] for j in best.query.tolist()], type=arrow.field(0).type),
                pa.array(list(best.name), type=arrow.field(1).type), pa.array(best.value, type=pa.float64())], schema=arrow)

    return score


def topk_per_query(scored: DataFrame, k: int, qid: str = "query_id", vec_id: str = "vec_id") -> DataFrame:
    """Rank inside each query; the limit is applied per task before the shuffle."""
    w = Window.partitionBy(qid).orderBy(F.desc("similarity"), vec_id)
    return (scored.withColumn("rank_no", F.row_number().over(w)).filter(F.col("rank_no") <= k)
            .withColumn("rank_no", F.col("rank_no").cast("long")))


def similarity_threshold(ranked: DataFrame, least: float = 0.5) -> DataFrame:
    return ranked.filter(F.col("similarity") > least)


# --- access -------------------------------------------------------------------------------

def visibility_tags(owner: Column, acl: Column, publish_status: Column, review_status: Column,
                    sanitization_status: Column) -> Column:
    """Tags a row can be found under: its owner, its team, the community. Revoked rows have
    none; rows waiting for a human are seen by their owner only until approved."""
    held = (sanitization_status == "human_review") & (review_status != "approved")
    mine = F.concat(F.lit("owner:"), owner)
    shared = F.when(F.startswith(acl, F.lit("team:")), acl).when(
        (acl == "public") & (publish_status == "published"), F.lit("community"))
    tags = F.array_compact(F.array(mine, F.when(~held, shared)))
    return F.when(review_status == "revoked", F.array().cast("array<string>")).otherwise(tags)


def viewer_tags(owner: Column, team: Column, unlocked: Column, scope: str = "auto") -> Column:
    mine = F.array(F.concat(F.lit("owner:"), owner), F.concat(F.lit("team:"), team))
    community = F.when(unlocked, F.array(F.lit("community"))).otherwise(F.array().cast("array<string>"))
    return {"personal": mine, "community": community, "auto": F.concat(mine, community)}[scope]


def visible_rows(experiences: DataFrame, owner: str, team: str, unlocked: bool,
                 scope: str = "auto") -> DataFrame:
    """Rows one viewer may see: a filter on visibility tags, no join."""
    tags = viewer_tags(F.lit(owner), F.lit(team), F.lit(unlocked), scope)
    return experiences.filter(F.arrays_overlap(visibility_tags(
        F.col("owner"), F.col("acl"), F.col("publish_status"), F.col("review_status"),
        F.col("sanitization_status")), tags))


def acl_join(viewers: DataFrame, experiences: DataFrame) -> DataFrame:
    """(viewer, n_own, n_team, n_community, n_visible): what each viewer may see.

    Rows are counted per tag first, and own rows also seen through a team or the community
    are taken out by their (owner, tag) count. Every join is an equi-join between counts, so
    viewer-row pairs never exist.
    """
    e = experiences.select("owner", visibility_tags(
        F.col("owner"), F.col("acl"), F.col("publish_status"), F.col("review_status"),
        F.col("sanitization_status")).alias("t")).filter(F.size("t") > 0).select(
        "owner", F.get("t", F.lit(1)).alias("shared"))
    both = e.groupBy("owner", "shared").agg(F.count(F.lit(1)).alias("n"))
    own = both.groupBy("owner").agg(F.sum("n").alias("n_own"))
    pairs = both.filter("shared IS NOT NULL")
    per_tag = pairs.groupBy("shared").agg(F.sum("n").alias("n_tag"))
    v = viewers.select("viewer", "owner", F.explode(F.filter(F.array(
        F.concat(F.lit("team:"), "team"), F.when(F.col("unlocked"), F.lit("community"))),
        lambda x: x.isNotNull())).alias("shared"))
    seen = (v.join(per_tag, "shared", "left").join(pairs, ["owner", "shared"], "left")
            .withColumn("extra", F.coalesce("n_tag", F.lit(0)) - F.coalesce("n", F.lit(0)))
            .groupBy("viewer").agg(
                F.sum(F.when(F.col("shared") != "community", F.coalesce("n_tag", F.lit(0))).otherwise(0)).alias("n_team"),
                F.sum(F.when(F.col("shared") == "community", F.coalesce("n_tag", F.lit(0))).otherwise(0)).alias("n_community"),
                F.sum("extra").alias("extra")))
    out = viewers.join(own, "owner", "left").join(seen, "viewer", "left")
    n_own = F.coalesce("n_own", F.lit(0).cast("long"))
    return out.select("viewer", n_own.alias("n_own"), "n_team", "n_community",
                      (n_own + F.col("extra")).alias("n_visible"))


def acl_filtered_search(queries: DataFrame, experiences: DataFrame, k: int = TOP_K,
                        scope: str = "auto", task_type: str | None = None) -> DataFrame:
    """Top-k of what each viewer may see. ``queries`` holds (query_id, query_vec, owner,
    team, unlocked); the access test runs before ranking, inside the scoring pass, so no
    viewer-row pairs are ever written."""
    rows = experiences if task_type is None else experiences.filter(F.col("task_type") == task_type)
    tagged = rows.withColumn("_tags", visibility_tags(
        F.col("owner"), F.col("acl"), F.col("publish_status"), F.col("review_status"),
        F.col("sanitization_status"))).filter(F.size("_tags") > 0)
    asking = queries.withColumn("_qtags", viewer_tags(
        F.col("owner"), F.col("team"), F.col("unlocked"), scope))
    return cosine_topk(asking, tagged, k, vec_id="experience_id", scope="_tags", qscope="_qtags")


def merge_scopes(personal: DataFrame, community: DataFrame, k: int = TOP_K) -> DataFrame:
    """Both result lists as one, best first, with where a row came from; a row found in both
    counts as personal."""
    both = (personal.withColumn("source", F.lit("personal")).unionByName(
        community.withColumn("source", F.lit("community"))))
    one = both.groupBy("query_id", "experience_id").agg(
        F.max("similarity").alias("similarity"), F.max("source").alias("source"))
    return topk_per_query(one, k, vec_id="experience_id")


def get_experience(experiences: DataFrame, turns: DataFrame, experience_id: str) -> DataFrame:
    """One stored row with its turns as rows in order (empty when there are none)."""
    one = experiences.filter(F.col("experience_id") == experience_id)
    mine = turns.filter(F.col("experience_id") == experience_id)
    return one.join(mine, "experience_id", "left")


# --- exact search with cells ---------------------------------------------------------------

def build_cells(vectors: DataFrame, n_cells: int = 64, *, vec_id: str = "vec_id",
                vec: str = "embedding") -> tuple[DataFrame, list]:
    """(vectors with ``cell`` and ``angle`` to its pivot, pivots). Pivots are ``n_cells`` rows
    picked by hash order, a bounded set; every vector goes to its nearest pivot."""
    spark = vectors.sparkSession
    rows = vectors.orderBy(F.xxhash64(vec_id), vec_id).limit(n_cells).select(vec).collect()
    pivots = _unit(np.asarray([r[0] for r in rows], dtype=np.float64))
    bc = spark.sparkContext.broadcast(pivots)
    schema = T.StructType([*vectors.select(vec_id, vec).schema.fields,
                           T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType())])
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def assign(batches):
        for b in batches:
            if b.num_rows:
                sims = _unit(_matrix(b.column(vec), bc.value.shape[1])) @ bc.value.T
                cell = sims.argmax(axis=1)
                angle = np.arccos(np.clip(sims[np.arange(len(cell)), cell], -1.0, 1.0))
                yield pa.RecordBatch.from_arrays(
                    [b.column(vec_id).cast(arrow.field(0).type), b.column(vec).cast(arrow.field(1).type),
                     pa.array(cell.astype(np.int32)), pa.array(angle)], schema=arrow)

    return vectors.select(vec_id, vec).mapInArrow(assign, schema), pivots


def cell_topk(queries: DataFrame, cells: DataFrame, pivots, k: int = TOP_K, *, probe: int = 4,
              qid: str = "query_id", qvec: str = "query_vec", vec_id: str = "vec_id",
              vec: str = "embedding") -> DataFrame:
    """Exact top-k that reads few cells. First the ``probe`` nearest cells give each query a
    k-th best similarity; then only cells that can still hold a better vector (by the
    triangle inequality on angles) are read. ``cells`` should be a table partitioned by cell,
    so that the cell filter prunes files. The result equals ``cosine_topk``."""
    radius = {r["cell"]: r["radius"] for r in
              cells.groupBy("cell").agg(F.max("angle").alias("radius")).collect()}  # one row per cell
    parts = [_block_topk(queries, rows, cells, pivots, radius, k, probe, qid, qvec, vec_id, vec)
             for rows in query_blocks(queries, qid, qvec, []) if rows]
    if not parts:
        return cosine_topk(queries, cells, k, qid=qid, qvec=qvec, vec_id=vec_id, vec=vec)
    return reduce(DataFrame.unionByName, parts)


def _block_topk(queries, rows, cells, pivots, radius, k, probe, qid, qvec, vec_id, vec) -> DataFrame:
    """Both passes for one block of queries; what the driver holds is bounded by the block."""
    sims = _unit(np.asarray([r[qvec] for r in rows], dtype=np.float64)) @ pivots.T
    angles = np.arccos(np.clip(sims, -1.0, 1.0))
    near, bound = {}, {}
    for r, a in zip(rows, angles):
        low = {c: max(0.0, a[c] - radius[c]) for c in radius}
        order = sorted(radius, key=lambda c: (low[c], a[c]))
        near[r[qid]], bound[r[qid]] = order[:probe], low
    first = _cell_pass(queries, cells, near, k, qid, qvec, vec_id, vec)
    floor = {r[0]: r[1] for r in first.groupBy(qid).agg(
        F.when(F.count(F.lit(1)) >= k, F.min("similarity")).alias("s")).collect()}
    more = {}
    for q_, low in bound.items():
        s = floor.get(q_)
        limit = np.pi if s is None else float(np.arccos(np.clip(s, -1.0, 1.0))) + 1e-9
        more[q_] = [c for c, a in low.items() if a <= limit and c not in near[q_]]
    if not any(more.values()):
        return first
    second = _cell_pass(queries, cells, more, k, qid, qvec, vec_id, vec)
    return topk_per_query(first.drop("rank_no").unionByName(second.drop("rank_no")), k, qid, vec_id)


def _cell_pass(queries, cells, chosen: dict, k, qid, qvec, vec_id, vec) -> DataFrame:
    wanted = sorted({c for cs in chosen.values() for c in cs})
    spark = queries.sparkSession
    tags = spark.createDataFrame([(q_, [str(c) for c in cs]) for q_, cs in chosen.items()],
                                 T.StructType([T.StructField(qid, queries.schema[qid].dataType),
                                               T.StructField("_cells", T.ArrayType(T.StringType()))]))
    asking = queries.join(F.broadcast(tags), qid)  # a block of queries at most
    part = cells.filter(F.col("cell").isin(wanted)).withColumn("_cell", F.array(F.col("cell").cast("string")))
    return cosine_topk(asking, part, k, qid=qid, qvec=qvec, vec_id=vec_id, vec=vec,
                       scope="_cell", qscope="_cells")
