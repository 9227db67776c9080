"""Log probabilities of whole documents under a recurrent model trained on the corpus.

1. Documents are gathered into stored batches. Each batch sends every distinct word (as a
   64-bit hash) once, with its count in training documents, to a bucket; buckets add up and
   send the corpus counts back. So corpus statistics cover all training documents, and a
   frequent word costs one entry per batch, not one row per occurrence.
2. The ``WORDS - 2`` most frequent words, an end and an unknown word are the model's words. Every batch
   is stored again as their numbers, with what the corpus counts say of each document.
3. Rounds of training: every batch cuts the words of its training documents into as many
   stretches as there are rounds and trains the current weights on one in each round, so the
   rounds together train on every training word once, a long document in several stretches;
   a task's weights are averaged, then those of all tasks, weighted by words.
4. Every document is scored whole, its state carried from window to window. A word outside
   the model's has the unknown word's probability times its share among all such words.

Defined results: null text is empty and scores its end alone; a null id counts as '' for the
held-out split; repeated rows are counted and scored each; an empty table gives no rows;
other columns are not read. Counts and ``base_score`` depend on the rows alone; ``score`` also on how the
rows are cut into batches and tasks, since weights are averaged over tasks.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm import recurrent
from tracelake.llm.blocks import LOWER, SPACE, Hashes, Texts, blocks
from tracelake.llm.stored import store

BATCH_BYTES = 8 << 20
ROUNDS = 3
END_HASH = np.uint64(1)          # no word has it: word hashes are set to be larger
FOLDS, HELD_OUT = 7, 2
END, UNKNOWN = 0, 1


def word_hashes(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of every row, each row closed by an end, and the rows' firsts."""
    low = LOWER[texts.data]
    words = texts.runs(~SPACE[texts.data])
    h = np.maximum(Hashes(low).of(words.start, words.end), np.uint64(2))
    count = words.per_row
    first = np.append(0, np.cumsum(count + 1))
    out = np.full(first[-1], END_HASH, np.uint64)
    body = np.ones(len(out), bool)
    body[first[1:] - 1] = False
    out[body] = h
    return out, first


def held_out(ids: list, folds: int = FOLDS, fold: int = HELD_OUT) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % folds == fold for i in ids], bool)


def gather(docs: DataFrame, batch_bytes: int) -> DataFrame:
    """``batch, ids, no_id, offsets, text`` (compressed) of groups of whole documents."""
    def pack(key: int, group) -> pa.RecordBatch:
        data = np.concatenate([t.data for _, t in group])
        ids = pa.concat_arrays([i for i, _ in group])
        offsets = np.append(0, np.cumsum(np.concatenate([np.diff(t.offsets) for _, t in group]))).astype(np.int64)
        row = [key, ids.fill_null(0).to_numpy().tobytes(), ids.is_null().to_numpy(zero_copy_only=False).tobytes(), offsets.tobytes(),
               zstandard.ZstdCompressor(level=3).compress(data.tobytes())]
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], ["batch", "ids", "no_id", "offsets", "text"])

    def run(batches):
        part, n, group, held = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for rows, texts in blocks(batch):
                if group and held + len(texts.data) > batch_bytes:
                    yield pack(part << 32 | n, group)
                    n, group, held = n + 1, [], 0
                group.append((rows.column(0), texts))
                held += len(texts.data)
        if group:
            yield pack(part << 32 | n, group)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return store(rows.mapInArrow(run, "batch long, ids binary, no_id binary, offsets binary, text binary"), "text-batches")


class _Batch:
    def __init__(self, row: dict):
        gone = np.frombuffer(row["no_id"], bool).tolist()
        self.ids = [None if z else i for i, z in zip(np.frombuffer(row["ids"], np.int64).tolist(), gone)]
        self.held = held_out(self.ids)
        self.texts = Texts(np.frombuffer(zstandard.ZstdDecompressor().decompress(row["text"]), np.uint8), np.frombuffer(row["offsets"], np.int64))

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of all rows, and the rows' firsts."""
        o = self.texts.offsets
        cuts = np.unique(np.append(np.searchsorted(o, np.arange(0, o[-1] + 1, 2 << 20)), len(o) - 1))
        some = [Texts(self.texts.data[o[a]:o[b]], o[a:b + 1] - o[a]) for a, b in zip(cuts[:-1], cuts[1:])]
        if len(o) > 1 and not some:
            some = [self.texts]
        got = [word_hashes(t) for t in some]
        first = [np.zeros(1, np.int64)]
        for h, f in got:
            first.append(f[1:] + first[-1][-1])
        return np.concatenate([h for h, _ in got]) if got else np.zeros(0, np.uint64), np.concatenate(first)


def _distinct(x: _Batch, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a batch as codes, their rows, the distinct hashes ordered by bucket, training counts, and the buckets' edges."""
    h, first = x.words()
    code, unique = pd.factorize(h)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    bucket = (unique % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    counts = np.bincount(rank[code][~x.held[row]], minlength=len(unique))
    return rank[code], row, first, unique[order], counts, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _announce(stored: DataFrame, buckets: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                _, _, _, unique, counts, edge = _distinct(_Batch(row), buckets)
                full = np.flatnonzero(np.diff(edge)).tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array(full, pa.int64()), pa.array([row["batch"]] * len(full), pa.int64()),
                    pa.array([unique[edge[k]:edge[k + 1]].tobytes() for k in full], pa.binary()),
                    pa.array([counts[edge[k]:edge[k + 1]].astype(np.uint32).tobytes() for k in full], pa.binary())],
                    ["bucket", "batch", "words", "counts"])

    return stored.mapInArrow(run, "bucket long, batch long, words binary, counts binary")


def _count(announced: DataFrame, top: int) -> DataFrame:
    """Replies ``batch, bucket, counts``, and one row per bucket without batch: its words, tokens and most frequent words."""
    def meet(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        words = np.concatenate([np.frombuffer(r["words"], np.uint64) for r in rows])
        counts = np.concatenate([np.frombuffer(r["counts"], np.uint32) for r in rows]).astype(np.int64)
        unique, code = np.unique(words, return_inverse=True)
        total = np.bincount(code, counts, len(unique)).astype(np.int64)
        told = total[code]
        edge = np.append(0, np.cumsum([len(r["words"]) // 8 for r in rows]))
        order = np.lexsort((unique, -total))[:top]
        order = order[total[order] > 0]
        none = [None] * len(rows)
        return pa.table({
            "batch": pa.array([*(r["batch"] for r in rows), None], pa.int64()), "bucket": pa.array([r["bucket"] for r in rows] + [rows[0]["bucket"]], pa.int64()),
            "counts": pa.array([*(told[a:b].astype(np.int64).tobytes() for a, b in zip(edge, edge[1:])), total[order].tobytes()], pa.binary()),
            "words": pa.array([*none, unique[order].tobytes()], pa.binary()),
            "tokens": pa.array([*none, int(total.sum())], pa.int64()), "types": pa.array([*none, int((total > 0).sum())], pa.int64())})

    return announced.groupBy("bucket").applyInArrow(meet, "batch long, bucket long, counts binary, words binary, tokens long, types long")


def _frequent(counted: DataFrame, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words' hashes and counts, most frequent first (at most ``top``)."""
    def each(batches):
        for b in batches:
            for w, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(w, np.int64)), pa.array(np.frombuffer(c, np.int64))], ["word", "n"])

    rows = counted.filter("batch IS NULL").select("words", "counts").mapInArrow(each, "word long, n long")
    rows = rows.filter(F.col("word") != int(END_HASH)).orderBy(F.desc("n"), "word").limit(top).collect()
    return np.array([r["word"] for r in rows], np.int64).view(np.uint64), np.array([r["n"] for r in rows], np.int64)


class Vocabulary:
    """The model's words: 0 the end, 1 unknown, then by falling frequency."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, end: int, tokens: int, types: int):
        self.sorted = np.argsort(hashes)
        self.hashes = hashes[self.sorted]
        self.rest = tokens - int(counts.sum()) - end + (types - len(hashes) - (end > 0)) + 1   # sum of c + 1 of all other words, unseen included
        self.tokens, self.types = tokens, types
        self.share = np.zeros(recurrent.WORDS)
        self.share[END], self.share[UNKNOWN] = end + 1, self.rest
        self.share[2:2 + len(counts)] = counts + 1
        self.share /= self.share.sum()

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), UNKNOWN, np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = self.hashes[at] == hashes
            out[hit] = self.sorted[at[hit]] + 2
        out[hashes == END_HASH] = END
        return out


INDEXED = ("batch long, ids binary, no_id binary, first binary, held binary, n_known binary, base binary, rare binary, words binary")


def _index(stored: DataFrame, counted: DataFrame, held, buckets: int) -> DataFrame:
    """Batches as numbers of the model's words (two bytes each, compressed), and per document the number of known
    words, the base score and the logarithm of the unknown words' shares."""
    def run(own: pa.Table, told: pa.Table) -> pa.Table:
        rows, v = [], held.value
        for row in own.to_pylist():
            x = _Batch(row)
            code, doc, first, unique, _, _ = _distinct(x, buckets)
            got = sorted(zip(told["bucket"].to_pylist(), told["counts"].to_pylist()))
            counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(c, np.int64) for _, c in got)])
            ids = v.ids(unique)
            base = np.log10((counts + 1) / (v.tokens + v.types + 1))
            rare = np.where(ids == UNKNOWN, np.log10((counts + 1) / v.rest), 0.0)
            n = len(first) - 1
            rows.append({"batch": row["batch"], "ids": row["ids"], "no_id": row["no_id"], "first": first.tobytes(), "held": x.held.tobytes(),
                         "n_known": np.bincount(doc, counts[code] > 0, n).astype(np.int64).tobytes(), "base": np.bincount(doc, base[code], n).tobytes(),
                         "rare": np.bincount(doc, rare[code], n).tobytes(),
                         "words": zstandard.ZstdCompressor(level=1).compress(ids.astype(np.uint16)[code].tobytes())})
        return pa.Table.from_pylist(rows, schema=pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.binary()) for c in INDEXED.split(", ")]))

    replies = counted.filter("batch IS NOT NULL").select("batch", "bucket", "counts")
    return store(stored.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(run, INDEXED), "word-batches")


def _words(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of an indexed batch, and the documents' firsts."""
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(row["words"]), np.uint16), np.frombuffer(row["first"], np.int64)


def stretch(row: dict, number: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of a batch's training documents that a round reads, and where a document begins; the rounds share all words."""
    words, first = _words(row)
    rows = np.flatnonzero(~np.frombuffer(row["held"], bool))
    rows = rows[np.argsort([zlib.crc32(str(r).encode()) for r in rows.tolist()], kind="stable")]
    size = np.diff(first)[rows]
    begin = np.cumsum(size) - size
    total = int(size.sum())
    lo, hi = total * number // rounds, total * (number + 1) // rounds
    fresh = np.zeros(total, bool)
    fresh[begin] = True
    at = np.arange(lo, hi) + np.repeat(first[:-1][rows] - begin, size)[lo:hi]
    return words[at].astype(np.int64), fresh[lo:hi]


def _train(indexed: DataFrame, flat: np.ndarray, number: int, rounds: int) -> np.ndarray:
    weights = indexed.sparkSession.sparkContext.broadcast(flat)  # of fixed size

    def run(batches):
        trainer, used = recurrent.Trainer(weights.value), 0
        for b in batches:
            for row in b.to_pylist():
                words, fresh = stretch(row, number, rounds)
                if len(words):
                    used += trainer.fit(words, fresh, END)
        if used:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([used], pa.int64()),
                                              pa.array([trainer.flat.tobytes()], pa.binary())], ["task", "used", "weights"])

    def average(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["task"])
        used = sum(r["used"] for r in rows)
        total = sum(np.frombuffer(r["weights"], np.float32).astype(np.float64) * (r["used"] / used) for r in rows)
        return pa.table({"task": pa.array([rows[0]["task"]], pa.int64()), "used": pa.array([used], pa.int64()),
                         "weights": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    schema = "task long, used long, weights binary"
    rows = store(indexed.select("held", "first", "words").mapInArrow(run, schema), "weights")
    tasks, step = rows.count(), 16
    while tasks > 16:   # averages of averages, sixteen tasks at a time
        rows = store(rows.withColumn("few", F.floor(F.col("task") / F.lit(step))).groupBy("few").applyInArrow(average, schema), "weights")
        step *= 16
        before, tasks = tasks, rows.count()
        if tasks == before:
            break
    last = rows.collect()
    if not last:
        return flat
    return np.frombuffer(average(pa.Table.from_pylist([r.asDict() for r in last]))["weights"][0].as_py(), np.float32)


def _score(indexed: DataFrame, flat: np.ndarray, tokens: int) -> DataFrame:
    weights = indexed.sparkSession.sparkContext.broadcast(flat)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                words, first = _words(row)
                n = len(first) - 1
                ln = recurrent.log_likelihoods(weights.value, words.astype(np.int64), first, END)
                model = np.bincount(np.repeat(np.arange(n), np.diff(first)), ln, n) / np.log(10) + np.frombuffer(row["rare"])
                ids = pa.array(np.frombuffer(row["ids"], np.int64), mask=np.frombuffer(row["no_id"], bool))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(np.frombuffer(row["held"], bool)), pa.array(np.diff(first)), pa.array(np.frombuffer(row["n_known"], np.int64)),
                    pa.array(np.full(n, tokens)), pa.array(np.frombuffer(row["base"])), pa.array(model)], names)

    return indexed.mapInArrow(run, schema)


def score_documents(docs: DataFrame, rounds: int = ROUNDS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    stored = gather(docs, batch_bytes)
    buckets = max(64, 2 * stored.count())
    top = recurrent.WORDS - 2
    counted = store(_count(_announce(stored, buckets), top), "counts")
    total = counted.filter("batch IS NULL").agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("types"), F.lit(0)).alias("v")).first()
    hashes, counts = _frequent(counted, top)
    end = docs_in_training(stored)
    vocabulary = Vocabulary(hashes, counts, end, total["n"], total["v"])
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a few thousand words at most
    indexed = _index(stored, counted, held, buckets)
    flat = recurrent.start(vocabulary.share)
    for number in range(rounds):
        flat = _train(indexed, flat, number, rounds)
    return _score(indexed, flat, vocabulary.tokens)


def docs_in_training(stored: DataFrame) -> int:
    """Training documents, which is the count of the end."""
    def run(batches):
        for b in batches:
            n = sum(int((~held_out([None if z else i for i, z in zip(np.frombuffer(ids, np.int64).tolist(), np.frombuffer(gone, bool).tolist())])).sum())
                    for ids, gone in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return stored.select("ids", "no_id").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
