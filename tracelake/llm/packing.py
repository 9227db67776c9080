"""Best-fit packing of token sequences by exact-complement hashing.

1. ``cut_pieces``: token ids of every document plus an end id, cut at the capacity, written
   once as narrow rows (with ids on request). A task numbers its pieces of each length.
2. ``plan_packing``: sees only the histogram of lengths (at most ``capacity`` rows, at any
   input size). Lengths are taken from long to short; the gap is filled by one, two or three
   lengths that sum to it exactly, found through availability, pair-sum and triple-sum
   indexes, as often as the counts allow. What has no complement goes best-fit-decreasing.
3. ``place``: prefix sums over tasks turn the task's numbers into a number among all pieces of
   a length, and the plan's rank ranges name sequence and offset.

Defined results: a null or empty text is the end id alone; repeated rows are packed each by
itself; doc_id may be null; an empty table gives no rows. The broadcast plan has a proven
bound: every step of the planner uses up a length or a group of bins, so it has at most a few
patterns per length, each with fewer than ``sqrt(2 * capacity)`` distinct lengths.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.llm.blocks import blocks
from tracelake.llm.tokens import encoder
from tracelake.session import materialize

CAPACITY = 4096
END_ID = 1

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("part", T.LongType()),
    T.StructField("number", T.LongType())])


def cut_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None,
               keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents, stored in the shared folder; ``ids`` (binary, little-endian
    unsigned 32-bit) on request. ``number`` counts a task's pieces of one length."""
    fields = PIECES.fields + ([T.StructField("ids", T.BinaryType())] if keep_ids else [])
    names = [f.name for f in fields]

    def run(batches):
        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows, texts in blocks(batch):
                ids, first = encode(texts)
                total = np.diff(first) + 1
                pieces = -(-total // capacity)
                row = np.repeat(np.arange(len(texts)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(capacity, total[row] - start)
                body, end = ids.astype("<u4").tobytes(), np.array([end_id], "<u4").tobytes()
                a = 4 * (first[row] + start)
                b = np.minimum(a + 4 * length, 4 * first[row + 1])
                tail = start + length == total[row]
                cuts = [body[x:y] + end if z else body[x:y] for x, y, z in zip(a.tolist(), b.tolist(), tail.tolist())]
                order = np.argsort(length, kind="stable")
                group = np.flatnonzero(np.append(True, np.diff(length[order]) > 0))
                number = np.empty(len(row), np.int64)
                number[order] = np.arange(len(row)) - np.repeat(group, np.diff(np.append(group, len(row))))
                number += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                cols = [rows.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                        pa.array([zlib.crc32(c) for c in cuts], pa.int64()), pa.array(np.full(len(row), part)), pa.array(number)]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array(cuts, pa.binary())] if keep_ids else []), names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(run, T.StructType(fields)), "pieces")


class _Lengths:
    """How many pieces of each length are left, and which gaps they can fill exactly."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.copy()
        self.capacity = len(counts) - 1
        self.pairs = np.zeros(self.capacity + 1, bool)   # sums of two lengths, never too few
        have = np.flatnonzero(counts > 0)
        for a in have:
            sums = a + have
            self.pairs[sums[sums <= self.capacity]] = True

    def pair(self, gap: int) -> tuple[int, ...]:
        """The pair with the longest part that sums to the gap."""
        a = np.arange((gap + 1) // 2, gap)
        ok = (self.left[a] > 0) & (self.left[gap - a] > 0) & ((2 * a != gap) | (self.left[a] > 1))
        hit = np.flatnonzero(ok)
        return (int(a[hit[-1]]), int(gap - a[hit[-1]])) if len(hit) else ()

    def complement(self, gap: int) -> tuple[int, ...]:
        if gap <= 0:
            return ()
        if self.left[gap] > 0:
            return (gap,)
        if self.pairs[gap]:
            two = self.pair(gap)
            if two:
                return two
            self.pairs[gap] = False  # lengths only run out: no later pair has this sum
        a = np.arange(gap - 2, 0, -1)
        for x in a[(self.left[a] > 0) & self.pairs[gap - a]].tolist():
            self.left[x] -= 1
            two = self.pair(gap - x)
            self.left[x] += 1
            if two:
                return (x, *two)
            if not self.left[x] == 1:
                self.pairs[gap - x] = False
        return ()


def plan_packing(counts: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """``counts[n]`` pieces of length n (index 0 unused) -> (length -> times per sequence, sequences)."""
    state = _Lengths(np.asarray(counts, np.int64))
    left, cap = state.left, len(counts) - 1
    plan: list[tuple[dict[int, int], int]] = []
    for length in range(cap, 0, -1):
        while left[length] > 0:
            left[length] -= 1
            fill = state.complement(cap - length)
            left[length] += 1
            if length < cap and not fill:
                break
            pattern: dict[int, int] = {}
            for x in (length, *fill):
                pattern[x] = pattern.get(x, 0) + 1
            times = min(int(left[x]) // n for x, n in pattern.items())
            for x, n in pattern.items():
                left[x] -= n * times
            plan.append((pattern, times))
    # best fit for what is left: groups of equal bins by free room
    room: dict[int, list[tuple[dict[int, int], int]]] = {}
    rooms: list[int] = []

    def put(pattern: dict[int, int], times: int, free: int) -> None:
        if free not in room:
            room[free] = []
            bisect.insort(rooms, free)
        room[free].append((pattern, times))

    for length in range(cap, 0, -1):
        n = int(left[length])
        while n:
            i = bisect.bisect_left(rooms, length)
            if i < len(rooms):
                free = rooms[i]
                pattern, times = room[free].pop()
                if not room[free]:
                    del room[free]
                    rooms.pop(i)
            else:
                free, pattern, times = cap, {}, n
            each = min(free // length, n)
            used = min(times, n // each)
            put({**pattern, length: pattern.get(length, 0) + each}, used, free - each * length)
            n -= used * each
            if times > used and pattern:
                put(pattern, times - used, free)
    return plan + [g for groups in room.values() for g in groups]


def slots(plan: list[tuple[dict[int, int], int]], capacity: int) -> dict[str, np.ndarray]:
    """Rank ranges of each length: from rank ``lo`` on, ``each`` pieces per sequence from ``sequence`` on at ``offset``."""
    next_rank = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for pattern, times in plan:
        offset = 0
        for length in sorted(pattern, reverse=True):
            each = pattern[length]
            rows.append((length, next_rank[length], each, sequence, offset))
            next_rank[length] += each * times
            offset += each * length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {k: table[:, i].copy() for i, k in enumerate(("length", "lo", "each", "sequence", "offset"))} | {
        "first": np.searchsorted(table[:, 0], np.arange(capacity + 2))}


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces."""
    spark = pieces.sparkSession
    by_task = materialize(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row per length at most
        counts[r["length"]] = r["n"]
    where = spark.sparkContext.broadcast(slots(plan_packing(counts), capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_task.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # one row per length and task: grows with the input, so it is never sent to all
    ranked = pieces.join(base.hint("merge"), ["length", "part"])
    ranked = ranked.select(*[c for c in pieces.columns if c not in ("part", "number")],
                           (F.col("base") + F.col("number")).alias("rank"))
    out = T.StructType([*ranked.schema.fields[:-1], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches):
        s = where.value
        key = s["length"] << 44 | s["lo"]  # ranks stay below 2**44
        for b in batches:
            length = b.column(b.schema.get_field_index("length")).to_numpy()
            rank = b.column(b.schema.get_field_index("rank")).to_numpy()
            at = np.searchsorted(key, length << 44 | rank, "right") - 1
            k = rank - s["lo"][at]
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            cols += [pa.array(s["sequence"][at] + k // s["each"][at]), pa.array(s["offset"][at] + k % s["each"][at] * length)]
            yield pa.RecordBatch.from_arrays(cols, out.names)

    return ranked.mapInArrow(run, out)


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None,
         keep_ids: bool = False) -> DataFrame:
    return place(cut_pieces(docs, capacity, end_id, tokenizer, keep_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Packed ids per sequence (bounded by the capacity) of a result with ``keep_ids=True``."""
    part = F.struct("offset", "ids", "doc_id", "piece")
    return packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("_p")).select(
        "sequence_id", F.expr("aggregate(_p, X'', (a, x) -> concat(a, x.ids))").alias("ids"),
        F.expr("transform(_p, x -> struct(x.doc_id, x.piece, x.offset))").alias("members"))
