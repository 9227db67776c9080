"""Row and session filters, session metadata, link between tool calls and results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.functions import text as tx

# Event types that carry no conversation.
META_TYPES = ("last-prompt", "queue-operation", "attachment", "file-history-snapshot",
              "permission-mode", "summary")
INTERRUPT = "[Request interrupted"
ARTIFACT = "<transcript>"


def drop_blank_turns(turns: DataFrame) -> DataFrame:
    says = ~tx.is_blank(F.col("content"))
    if "tool_calls" in turns.columns:
        says = says | (F.coalesce(F.size("tool_calls"), F.lit(0)) > 0)
    return turns.filter(says)


def meta_type_filter(events: DataFrame, col: str = "type") -> DataFrame:
    return events.filter(F.col(col).isNull() | ~F.col(col).isin(*META_TYPES))


def interrupt_filter(turns: DataFrame) -> DataFrame:
    return turns.filter(~((F.col("role") == "user") & F.startswith("content", F.lit(INTERRUPT))))


def artifact_flag() -> Column:
    """Aggregate over a session's turns: whether its first user turn is a packed transcript of another session."""
    return F.min_by(F.startswith(tx.lstrip(F.col("content")), F.lit(ARTIFACT)), F.when(F.col("role") == "user", F.col("turn_index")))


def artifact_sessions(turns: DataFrame) -> DataFrame:
    """Sessions whose first user turn is a packed transcript of another session."""
    first = turns.filter("role = 'user'").groupBy("session_id").agg(artifact_flag().alias("a"))
    return first.filter("a").select("session_id")


def artifact_filter(turns: DataFrame) -> DataFrame:
    return turns.join(artifact_sessions(turns), "session_id", "left_anti")


def size_cap_filter(files: DataFrame, max_kb: int = 4096, floor_kb: int = 64,
                    size: str = "size_bytes") -> DataFrame:
    """Sessions up to the cap; a cap below the floor is raised to it, 0 switches it off."""
    return files if max_kb == 0 else files.filter(fits(max_kb, floor_kb, size))


def fits(max_kb: int = 4096, floor_kb: int = 64, size: str = "size_bytes") -> Column:
    return F.lit(True) if max_kb == 0 else F.coalesce(F.col(size), F.lit(0)) <= max(floor_kb, max_kb) * 1024


def since_filter(files: DataFrame, since, mtime: str = "mtime") -> DataFrame:
    return files.filter(F.col(mtime) >= F.lit(since))


def session_meta(events: DataFrame, order: str = "line_no", newest: bool = True) -> DataFrame:
    """Start and end time, version, folder and model of every session; the latest non-blank
    value counts (event logs) or the first one (rollouts)."""
    pick = F.max_by if newest else F.min_by

    def of(col, f):
        c = F.col(col)
        return f(F.when(F.coalesce(c, F.lit("")) != "", c),
                 F.when(F.coalesce(c, F.lit("")) != "", F.col(order)))

    model = F.when(F.col("model") != "<synthetic>", F.col("model"))
    rows = events.withColumn("model", model)
    out = rows.groupBy("session_id").agg(
        of("ts", F.min_by).alias("started_at"), of("ts", F.max_by).alias("ended_at"),
        of("version", pick).alias("agent_version"), of("cwd", pick).alias("cwd"),
        of("model", pick).alias("model"))
    return out.select("session_id", *[
        F.coalesce(c, F.lit("unknown" if c == "model" else "")).alias(c)
        for c in ("started_at", "ended_at", "agent_version", "cwd", "model")])


def tool_link(turns: DataFrame) -> DataFrame:
    """(session_id, call_id, name, n_calls, n_results): calls with and without a result.

    Both sides are counted per id before they meet, so a repeated id cannot fan out.
    """
    calls = (turns.select("session_id", F.explode("tool_calls").alias("c"))
             .filter("c.id <> ''").groupBy("session_id", F.col("c.id").alias("call_id"))
             .agg(F.min("c.name").alias("name"), F.count(F.lit(1)).alias("n_calls")))
    results = (turns.filter("tool_result_for <> ''")
               .groupBy("session_id", F.col("tool_result_for").alias("call_id"))
               .agg(F.count(F.lit(1)).alias("n_results")))
    return calls.join(results, ["session_id", "call_id"], "left").fillna(0, ["n_results"])


def block_census(turns: DataFrame) -> DataFrame:
    """Turns per session by kind."""
    calls = F.coalesce(F.size("tool_calls"), F.lit(0)) if "tool_calls" in turns.columns else F.lit(0)
    role = F.col("role")
    return turns.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.count_if(role == "user").alias("n_user"),
        F.count_if(role == "assistant").alias("n_assistant"),
        F.count_if(role == "system").alias("n_system"), F.count_if(role == "tool").alias("n_tool"),
        F.sum(calls.cast("long")).alias("n_calls"))
