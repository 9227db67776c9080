"""Structured Streaming: incremental ingest, redaction, de-duplication, metrics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracelake.functions.redact import redact
from tracelake.functions.rules import DEFAULT_RULES, Rule
from tracelake.operators import dedup as dd
from tracelake.operators import governance as gv
from tracelake.plans.jobs import allowed_turns, push, tick
from tracelake.sources.base import session_key
from tracelake.sources.event_log import event_turns
from tracelake.sources.ledger import PRINTS, lookup, write_ledger


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None,
                 glob: str = "*.jsonl") -> DataFrame:
    """New session files as raw lines. A file is read in one micro-batch as a whole."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size_bytes"), F.col("value").alias("raw"))


def batch_name(spark: SparkSession, batch_id: int) -> str:
    """Name of a micro-batch: the stream's id, which its checkpoint keeps, and the number. So
    several streams, or one with a new checkpoint, may fill one table."""
    stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
    return f"{stream}-{batch_id:09d}"


def stored_ledger(spark: SparkSession, out: str, batch: str, prints: DataFrame) -> DataFrame | None:
    """What the ledger of all other batches, whatever wrote them, holds of ``prints``. The batch itself is
    left out, so that repeating it after a failure gives the same rows again."""
    known = lookup(spark, out, batch, prints)
    return None if known is None else known.drop("batch", "prefix")


def stream_sync(spark: SparkSession, path: str, out: str, checkpoint: str, agent_id: str,
                policy: tuple | None, max_files: int | None = None,
                to_turns: Callable[[DataFrame], DataFrame] = event_turns,
                rules: tuple[Rule, ...] = DEFAULT_RULES, interval: str | None = None,
                glob: str = "*.jsonl", source: str = "event_log", agent: str = "", max_kb: int | None = None,
                session: Callable[[Column], Column] = session_key, now: dt.datetime | None = None) -> StreamingQuery:
    """Ingest new files that consent lets through into the gold tables, exactly once.

    Every session meets the gate (``policy`` as of ``policy_tables``; without one nothing
    passes), the size cap and the artifact filter, as in ``tick``; what became of it is
    stored with its batch in ``outcomes``.
    Every table is written per batch into that batch's folder, so a repeated batch replaces
    its own rows. Content known from earlier batches is dropped by its fingerprint; a session
    that has grown is a new row. The source lists its files while the query runs: where there are
    very many, start and await it inside ``many_folders``.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        lines = batch.withColumn("seq", F.monotonically_increasing_id()).withColumn("session_id", session(F.col("path")))
        cwd = F.get_json_object("raw", "$.cwd")
        sessions = lines.groupBy("session_id").agg(
            F.coalesce(F.min_by(cwd, F.when(F.coalesce(cwd, F.lit("")) != "", F.struct("block", "seq"))), F.lit("")).alias("cwd"),
            F.max("size_bytes").alias("size_bytes")).select(
            F.lit(source).alias("source"), "session_id", F.lit(agent).alias("agent"), "cwd", F.lit("").alias("mtime"), "size_bytes")
        # parsed once; kept as Spark keeps any table of a batch, not stored before it is redacted
        turns = to_turns(lines).withColumn("source", F.lit(source)).persist()
        nothing = spark.createDataFrame([], "source string, session_id string")
        outcomes, _ = tick(turns, sessions, nothing, policy, now or dt.datetime.now(dt.timezone.utc), max_kb=max_kb)
        name = batch_name(spark, batch_id)
        try:
            outcomes.select("source", "session_id", "status").write.mode("overwrite").parquet(f"{out}/outcomes/batch={name}")
            allowed = allowed_turns(turns, spark.read.parquet(f"{out}/outcomes/batch={name}"))
            push(spark, allowed, out, agent_id, name, lambda prints: stored_ledger(spark, out, name, prints), rules)
        finally:
            turns.unpersist()

    writer = stream_lines(spark, path, max_files, glob).writeStream.foreachBatch(sink).option(
        "checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def stream_redact(rows: DataFrame, cols: list[str], rules: tuple[Rule, ...] = DEFAULT_RULES,
                  pieces: int | None = None) -> DataFrame:
    """Stateless redaction of a stream: nothing raw is ever written. ``pieces`` deals out
    micro-batches of fewer files than cores."""
    out = rows if pieces is None else rows.repartition(pieces)
    for c in cols:
        out = out.withColumn(c, redact(F.coalesce(F.col(c), F.lit("")), rules)["text"])
    return out


def stream_dedup(prints: DataFrame, time_col: str, delay: str) -> DataFrame:
    """Drop copies seen within the delay; state older than the watermark is given up. For
    copies at any distance use ``ledger_dedup`` in a foreachBatch."""
    return prints.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["agent_id", "fingerprint"])


def stream_seen_ids(sessions: DataFrame, time_col: str, ttl: str) -> DataFrame:
    """Ids not seen within ``ttl``: bounded memory of what was handled."""
    return sessions.withWatermark(time_col, ttl).dropDuplicatesWithinWatermark(["source", "session_id"])


def ledger_dedup(out: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: exact de-duplication across all batches by the stored ledger."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = batch_name(spark, batch_id)
        ledger = stored_ledger(spark, out, name, batch)
        new = dd.dedup_sessions(batch) if ledger is None else dd.dedup_ledger_antijoin(batch, ledger)[0]
        new.select("agent_id", "fingerprint", "session_id", F.concat(F.lit("x-"), "session_id").alias("experience_id")
                   ).write.mode("overwrite").parquet(f"{out}/fingerprints/batch={name}")
        write_ledger(spark.read.schema(PRINTS).parquet(f"{out}/fingerprints/batch={name}"), out, name)
    return sink


def tick_windows(outcomes: DataFrame, time_col: str, interval: str = "120 seconds",
                 delay: str = "10 minutes") -> DataFrame:
    """Sync outcomes per source and tick interval, closed by the watermark."""
    s = F.col("status")
    return (outcomes.withWatermark(time_col, delay).groupBy(F.window(time_col, interval).alias("w"), "source").agg(
        F.count_if(s == "uploaded").alias("uploaded"), F.count_if(F.startswith(s, F.lit("skipped"))).alias("skipped"),
        F.count_if(s == "failed").alias("failed"))
        .select(F.col("w.start").alias("tick_start"), "source", "uploaded", "skipped", "failed"))


def tick_metrics_sink(out: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: one summary per micro-batch."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        gv.sync_summary(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_name(batch.sparkSession, batch_id)}")
    return sink


def deep_drain(waiting: DataFrame, results: DataFrame) -> DataFrame:
    """Stream-static join: waiting rows that have a deep result leave the queue as done. Of
    repeated results one counts, as in ``deep_pass``."""
    return (waiting.filter("sanitization_status = 'layer1_only'")
            .join(results.groupBy("experience_id").agg(F.max("strict_redactions").alias("_res")), "experience_id")
            .withColumn("strict_redactions", F.col("_res")).withColumn("sanitization_status", F.lit("done")).drop("_res"))


def run_to_end(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Drain what is available into a table and read it back."""
    spark = stream.sparkSession
    query = (stream.writeStream.outputMode(mode).format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def run_batches(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()
