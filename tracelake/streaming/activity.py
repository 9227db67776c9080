"""Bursts of activity, the deep-pass queue against late verdicts, and metrics that cost no pass of their own."""

from __future__ import annotations

import threading
import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

STATUSES = {"uploaded": "status = 'uploaded'", "skipped": "startswith(status, 'skipped')",
            "skipped_consent": "status = 'skipped_consent'", "failed": "status = 'failed'"}


def activity_windows(events: DataFrame, keys: list[str], time_col: str, gap: str = "30 minutes", delay: str = "10 minutes",
                     measures: dict[str, str] | None = None) -> DataFrame:
    """One row per burst of events of a key: a pause of more than ``gap`` ends it.

    ``started`` and ``ended`` are the first and the last event. Windows merge in the state as events
    arrive in any order within ``delay``; a burst is given out once, when the watermark has passed its gap.
    ``measures`` maps further columns to aggregate expressions.
    """
    rows = events.withWatermark(time_col, delay).groupBy(F.session_window(time_col, gap).alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("n_events"), F.min(time_col).alias("started"), F.max(time_col).alias("ended"),
        *[F.expr(e).alias(c) for c, e in (measures or {}).items()])
    return rows.select(*keys, "started", "ended", "n_events", *(measures or {}))


def deep_queue(queue: DataFrame, verdicts: DataFrame, within: str = "7 days", early: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Waiting rows (experience_id, queued_at) and their verdicts (experience_id, verdict_at, strict_redactions), both streams.

    A row is 'done' as soon as both sides are there, in whatever order they arrive, if the verdict is at most
    ``early`` older and ``within`` younger than the row. Without one it is given out as 'expired', once the watermark
    of both streams has passed its time; a verdict that is later than that meets nothing. Of repeated verdicts
    the first to arrive counts.
    """
    first = verdicts.withWatermark("verdict_at", delay).dropDuplicatesWithinWatermark(["experience_id"]).withColumnRenamed("experience_id", "_id")
    waiting = queue.withWatermark("queued_at", delay)
    near = F.expr(f"experience_id = _id AND verdict_at >= queued_at - INTERVAL {early} AND verdict_at <= queued_at + INTERVAL {within}")
    return waiting.join(first, near, "leftOuter").select(
        *queue.columns, F.when(F.col("_id").isNotNull(), "done").otherwise("expired").alias("sanitization_status"), "verdict_at", "strict_redactions")


def observed(outcomes: DataFrame, sources: Iterable[str], name: str = "tick") -> DataFrame:
    """The same rows, with their ``sync_summary`` counted on the way to wherever they go.

    ``sources`` are the names to count by, a registry's few; other rows count in the total only.
    """
    cells = [F.count_if(F.expr(test)).alias(f"{what}:*total*") for what, test in STATUSES.items()]
    cells.append(F.count(F.lit(1)).alias("available_now:*total*"))
    for s in sources:
        mine = F.col("source") == s
        cells += [F.count_if(mine & F.expr(test)).alias(f"{what}:{s}") for what, test in STATUSES.items()]
        cells.append(F.count_if(mine).alias(f"available_now:{s}"))
    return outcomes.observe(name, *cells)


class BatchMetrics(StreamingQueryListener):
    """Collects what ``observed`` has counted: one row per micro-batch and source."""

    COLUMNS = ("batch_id", "source", *STATUSES, "available_now")
    SCHEMA = "batch_id long, source string, " + ", ".join(f"{c} long" for c in (*STATUSES, "available_now"))

    def __init__(self, name: str = "tick"):
        self.name, self.rows, self.last = name, [], {}
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self.changed:
            seen = (p.observedMetrics or {}).get(self.name)
            if seen is not None:
                by_source: dict[str, dict] = {}
                for cell, n in seen.asDict().items():
                    what, source = cell.split(":", 1)
                    by_source.setdefault(source, {})[what] = n
                self.rows += [(p.batchId, s, *(c[w] for w in (*STATUSES, "available_now"))) for s, c in by_source.items() if c["available_now"]]
            self.last[str(p.runId)] = p.batchId
            self.changed.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.last[str(event.runId)] = None
            self.changed.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until the events of an ended query have arrived; they come on a thread of their own."""
        end = time.monotonic() + seconds
        with self.changed:
            while self.last.get(str(query.runId), 0) is not None:
                if not self.changed.wait(max(0.0, end - time.monotonic())):
                    raise TimeoutError("no end of the query was reported")

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, self.SCHEMA)


def run_observed(outcomes: DataFrame, sources: Iterable[str], out: str, checkpoint: str) -> BatchMetrics:
    """Drain a stream of outcomes into a table; the metrics of its batches are counted by the same pass."""
    spark = outcomes.sparkSession
    metrics = BatchMetrics()
    spark.streams.addListener(metrics)
    try:
        query = observed(outcomes, sources).writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        metrics.wait(query)
    finally:
        spark.streams.removeListener(metrics)
    return metrics
