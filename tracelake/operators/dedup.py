"""Fingerprint de-duplication inside a batch, against the ledger, and across pushes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.operators.scan import first_rows

KEY = ["agent_id", "fingerprint"]


def dedup_clusters(prints: DataFrame, arrival: str = "arrival") -> DataFrame:
    """One row per (agent, fingerprint): the session that came first and how many share it.

    A group of copies may be a third of the input; it is reduced on the map side, so the
    shuffle sees one row per task and key.
    """
    return prints.groupBy(*KEY).agg(
        F.min(F.struct(F.col(arrival).alias("at"), F.col("session_id").alias("id"))).alias("f"),
        F.count(F.lit(1)).alias("n_copies")
    ).select(*KEY, F.col("f.id").alias("session_id"), F.col("f.at").alias(arrival), "n_copies")


def dedup_sessions(prints: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Sessions kept: the first of every cluster."""
    return dedup_clusters(prints, arrival).drop("n_copies")


def duplicates(prints: DataFrame, arrival: str = "arrival") -> DataFrame:
    """(session_id, kept_id) of every copy that is not kept. The kept side has one row per
    key, so a hot key only makes the left side long, which the adaptive join splits."""
    kept = dedup_clusters(prints, arrival).filter("n_copies > 1").select(
        *KEY, F.col("session_id").alias("kept_id"))
    return prints.join(kept, KEY).filter(F.col("session_id") != F.col("kept_id")).select(
        "session_id", "agent_id", "fingerprint", "kept_id")


def dedup_ledger_antijoin(prints: DataFrame, ledger: DataFrame,
                          arrival: str = "arrival") -> tuple[DataFrame, DataFrame]:
    """(new, known). Keys are made unique before they meet the ledger; a known key answers
    with the stored experience id."""
    first = dedup_sessions(prints, arrival)
    new = first.join(ledger.select(*KEY), KEY, "left_anti")
    stored = ledger.groupBy(*KEY).agg(F.min("experience_id").alias("experience_id"))
    known = prints.join(stored, KEY).select("session_id", *KEY, "experience_id")
    return new, known


def seen_id_antijoin(sessions: DataFrame, seen: DataFrame) -> DataFrame:
    return sessions.join(seen.select("source", "session_id"), ["source", "session_id"], "left_anti")


def merge_seen_ids(old: DataFrame, new: DataFrame, keep: int = 5000) -> DataFrame:
    """Union of both id lists, newest ``keep`` per source; a source may hold most rows."""
    both = old.unionByName(new).groupBy("source", "session_id").agg(F.max("seen_at").alias("seen_at"))
    return first_rows(both, ["source"], [F.desc("seen_at"), F.desc("session_id")], keep)


def replace_rule(rules: DataFrame, new: DataFrame, key: str = "glob") -> DataFrame:
    """Idempotent upsert: a rule with the same key is replaced and moves to the end."""
    return rules.join(new.select(key), key, "left_anti").unionByName(new)


def session_end_repush(pushes: DataFrame, latest_only: bool = False) -> DataFrame:
    """Pushes of growing sessions: equal content collapses to its first push, grown content
    is a row of its own; optionally only the latest row per session."""
    rows = pushes.groupBy("agent_id", "session_id", "fingerprint").agg(
        F.min("push_no").alias("push_no"), F.count(F.lit(1)).alias("n_pushes"))
    if not latest_only:
        return rows
    return (rows.groupBy("agent_id", "session_id")
            .agg(F.max(F.struct("push_no", "fingerprint", "n_pushes")).alias("l"))
            .select("agent_id", "session_id", "l.*"))
