"""Fingerprints of growing sessions: the sums behind a fingerprint are kept, and only new turns are hashed.

A turn's hash holds its position, and a session's fingerprint is a hash of the number of its turns and of the
sums of their hashes. Sums add up, so what is known of a session's first turns and what is new of its later ones
give the fingerprint of the whole, however the session was cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.operators.cards import PIECES, turn_digest
from tracelake.operators.scan import running

SUMS = tuple(f"l{i}" for i in range(PIECES))
STATE = "session_id string, n_turns long, last_index long, " + ", ".join(f"{c} long" for c in SUMS)


def unseen(turns: DataFrame, state: DataFrame) -> DataFrame:
    """Turns after the last one that is known of their session, with ``_before``, the number known. The state has one
    row per session, so a session of any length only makes the left side long."""
    known = state.select("session_id", F.col("n_turns").alias("_before"), F.col("last_index").alias("_last"))
    rows = turns.join(known, "session_id", "left").filter(F.col("_last").isNull() | (F.col("turn_index") > F.col("_last")))
    return rows.withColumn("_before", F.coalesce("_before", F.lit(0).cast("long"))).drop("_last")


def digest_state(turns: DataFrame) -> DataFrame:
    """``session_id, n_turns, last_index`` and the sums of hashes, of the turns given (``_before`` of them come before)."""
    names = F.transform("tool_calls", lambda c: c["name"]) if "tool_calls" in turns.columns else None
    before = F.col("_before") if "_before" in turns.columns else F.lit(0).cast("long")
    h = turns.select("session_id", "turn_index", before.alias("_before"), turn_digest(F.col("role"), F.col("content"), names).alias("_d"))
    h = running(h, ["session_id"], ["turn_index"], sums={"_at": F.lit(1)}).select(
        "session_id", "turn_index", F.sha2(F.concat_ws("\u001f", (F.col("_before") + F.col("_at")).cast("string"), "_d"), 256).alias("h"))
    limbs = [F.conv(F.substring("h", 1 + 7 * i, 7), 16, 10).cast("long") for i in range(PIECES)]
    return h.groupBy("session_id").agg(F.count(F.lit(1)).alias("n_turns"), F.max("turn_index").cast("long").alias("last_index"),
                                       *[F.sum(e).alias(c) for c, e in zip(SUMS, limbs)])


def grown(state: DataFrame, turns: DataFrame) -> DataFrame:
    """The state after ``turns``, of which those that are known already are not hashed again."""
    new = digest_state(unseen(turns, state))
    return state.unionByName(new).groupBy("session_id").agg(
        F.sum("n_turns").alias("n_turns"), F.max("last_index").alias("last_index"), *[F.sum(c).alias(c) for c in SUMS])


def fingerprint_of(state: DataFrame) -> DataFrame:
    """(session_id, n_turns, fingerprint), equal to ``fingerprint`` over all turns of the sessions."""
    parts: list[Column] = [F.col("n_turns").cast("string"), *[F.col(c).cast("string") for c in SUMS]]
    return state.select("session_id", "n_turns", F.sha2(F.concat_ws("-", *parts), 256).alias("fingerprint"))
