"""Chat message tables: threads, participants, turns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tracelake.operators import scan
from tracelake.sources.base import no_calls

DEFAULT_HUMANS = ("user", "human")


def chat_to_turns(messages: DataFrame, humans: tuple[str, ...] = DEFAULT_HUMANS,
                  bucket: int = 13, id_chars: int = 6) -> DataFrame:
    """Messages of every thread in the order of time and id.

    A thread is numbered in pieces of one second and a run of message ids; the first
    ``bucket`` characters of the time (an hour) carry the counts of pieces. Runs follow the
    order of the ids themselves: a number divided by the chunk length, or the first
    ``id_chars`` characters of a text.
    """
    place = F.when(F.coalesce("workflow", F.lit("")) != "", F.concat(
        F.lit(" /"), "workflow", F.lit("/"), F.coalesce("stage", F.lit("None")))).otherwise("")
    tag = F.concat(F.lit("["), "sender", F.lit("→"), F.coalesce("recipient", F.lit("None")), place, F.lit("] "))
    rows = messages.select(
        F.col("thread_id").alias("session_id"), F.coalesce("ts", F.lit("")).alias("ts"), "id",
        F.when(F.col("sender").isin(*humans), "user").otherwise("assistant").alias("role"),
        F.concat(tag, F.coalesce("content", F.lit(""))).alias("content"))
    text_ids = isinstance(messages.schema["id"].dataType, StringType)
    run = F.substring("id", 1, id_chars) if text_ids else F.floor(F.col("id") / scan.CHUNK)
    chunk = F.struct(F.substring("ts", 1, bucket).alias("hour"), F.col("ts").alias("second"), run.alias("run"))
    numbered = scan.running(rows, ["session_id"], ["ts", "id"], sums={"turn_index": F.lit(1)}, chunk=chunk, coarse="hour")
    return numbered.select("session_id", "turn_index", "role", "content", "ts",
                           no_calls().alias("tool_calls"), F.lit("").alias("tool_result_for"))


def find_thread(messages: DataFrame, ident: str, limit: int | None = None) -> DataFrame:
    """Messages of the thread with this id; without one, those of all threads whose id starts
    with it, or the first ``limit`` of them."""
    exact = messages.filter(F.col("thread_id") == ident)
    near = messages.filter(F.startswith("thread_id", F.lit(ident)) & (F.col("thread_id") != ident))
    near = near if limit is None else near.orderBy("ts", "id").limit(limit)
    found = exact.limit(1).select(F.col("thread_id").alias("_start"))
    start = F.substring("thread_id", 1, len(ident))
    return exact.unionByName(near.withColumn("_start", start).join(found, "_start", "left_anti").drop("_start"))


def thread_participants(messages: DataFrame) -> DataFrame:
    """(thread_id, participant): distinct senders as rows."""
    return messages.select("thread_id", F.col("sender").alias("participant")).distinct()


def list_threads(messages: DataFrame, limit: int = 50) -> DataFrame:
    """Latest threads with their counts of messages and senders; the senders themselves are
    the rows of ``thread_participants``. Senders are looked up for the listed threads only."""
    top = messages.groupBy("thread_id").agg(
        F.count(F.lit(1)).alias("msg_count"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    ).orderBy(F.desc("last_ts"), "thread_id").limit(limit)
    pairs = thread_participants(messages.join(top.select("thread_id"), "thread_id", "left_semi"))
    sizes = pairs.groupBy("thread_id").agg(F.count(F.lit(1)).alias("n_senders"))
    return top.join(sizes, "thread_id", "left")
