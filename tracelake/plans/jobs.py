"""End-to-end jobs: push, tick, search, annotate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions.rules import DEFAULT_RULES, Rule
from tracelake.functions.vectors import text_vectors
from tracelake.operators import cards as cd
from tracelake.operators import consent as cs
from tracelake.operators import dedup as dd
from tracelake.operators import filters as fl
from tracelake.operators import governance as gv
from tracelake.operators import pairs as pr
from tracelake.operators import rewards as rw
from tracelake.operators import search as se
from tracelake.session import materialize
from tracelake.sources.ledger import write_ledger
from tracelake.sources.sinks import write_gold


def whole_id(source: str = "source", session: str = "session_id") -> Column:
    """A session is named by its source and its id there; two sources may use one id."""
    return F.concat_ws("/", source, session)


def push(spark: SparkSession, turns: DataFrame, path: str, agent_id: str, batch: str,
         ledger: DataFrame | Callable[[DataFrame], DataFrame | None] | None = None, rules: tuple[Rule, ...] = DEFAULT_RULES,
         constants: dict | None = None) -> dict[str, str]:
    """Turns -> stored tables of one batch. With a ``source`` column, sessions are stored under
    ``source/session_id``. ``ledger`` is a table of known fingerprints, or gives one for the new ones.

    Fingerprint and ledger come first, so the expensive rules only see new content. Redacted
    turns are written once and everything else is derived from that table: the rules run once
    per turn, and a lost executor only repeats its own part.
    """
    if "source" in turns.columns:
        turns = turns.withColumn("session_id", whole_id()).drop("source")
    prints = cd.fingerprint(turns).select(
        F.lit(agent_id).alias("agent_id"), "session_id", "fingerprint", F.col("session_id").alias("arrival"))
    if callable(ledger):
        prints = materialize(prints, "prints")
        ledger = ledger(prints)
    new = dd.dedup_sessions(prints) if ledger is None else dd.dedup_ledger_antijoin(prints, ledger)[0]
    new = new.select("agent_id", "fingerprint", "session_id",
                     F.concat_ws("-", F.lit("x"), "session_id", F.substring("fingerprint", 1, 12)).alias("experience_id"))
    paths = write_gold({"fingerprints": new}, path, batch)
    kept = spark.read.schema(new.schema).parquet(f"{path}/fingerprints/batch={batch}")
    write_ledger(kept, path, batch)

    fresh = turns.join(kept.select("session_id", "experience_id"), "session_id")
    paths |= write_gold({"turns": cd.redact_turns(fresh, rules)}, path, batch)
    clean = spark.read.parquet(f"{path}/turns/batch={batch}")

    cards = gv.review_routing(cd.card_core(clean, rules, **(constants or {}))).join(
        kept.select("session_id", "experience_id"), "session_id")
    paths |= write_gold({"cards": cards, "steps": cd.card_steps(clean)}, path, batch)
    stored = spark.read.parquet(f"{path}/cards/batch={batch}")
    audit = stored.select("experience_id", F.lit(agent_id).alias("actor"), F.lit("push").alias("action"))
    vectors = text_vectors(stored.select("experience_id", F.concat_ws(" ", "intent", "query").alias("t")),
                           "experience_id", "t")
    return paths | write_gold({"vectors": vectors, "audit": audit}, path, batch)


def tick(turns: DataFrame, sessions: DataFrame, seen: DataFrame, policy: tuple | None, now: dt.datetime,
         max_per_source: int | None = None, max_kb: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(outcomes, turns to push) of one sync run.

    ``sessions`` holds (source, session_id, agent, cwd, mtime, size_bytes), ``turns`` also has
    its ``source``; everything meets on both. The caps are off unless given (10 and 4096 are
    usual). The status of a session tells why it was left out: ``skipped_seen``,
    ``skipped_size``, ``skipped_empty``, ``skipped_artifact``, ``skipped_consent`` or
    ``skipped_cap``. A session that consent holds back is not remembered, so a later 'always'
    picks it up.
    """
    key = ["source", "session_id"]
    # one row per session with all that decides; a session's status is the first test it fails
    own = fl.artifact_flag()
    flags = turns.groupBy(*key).agg(F.lit(True).alias("_turns"), F.coalesce(own, F.lit(False)).alias("_artifact"))
    rows = sessions.join(seen.select(*key).distinct().withColumn("_seen", F.lit(True)), key, "left").join(flags, key, "left")
    too_big = F.lit(False) if max_kb is None else ~fl.fits(max_kb)
    rows = rows.withColumn("_left", F.when(F.col("_seen"), "skipped_seen").when(too_big, "skipped_size").when(
        F.col("_turns").isNull(), "skipped_empty").when(F.col("_artifact"), "skipped_artifact")).drop("_seen", "_turns", "_artifact")
    gated = cs.no_policy_gate(rows) if policy is None else cs.consent_gate(cs.consent_decide(rows, *policy, now))
    status = F.coalesce("_left", F.when(~F.col("allow"), "skipped_consent"), F.lit("uploaded"))
    outcomes = gated.select(*sessions.columns, status.alias("status"))
    if max_per_source is not None:
        kept = gv.cap_per_source(outcomes.filter("status = 'uploaded'"), max_per_source).select(*key).withColumn("_kept", F.lit(True))
        outcomes = outcomes.join(kept, key, "left").withColumn("status", F.when(
            (F.col("status") == "uploaded") & F.col("_kept").isNull(), "skipped_cap").otherwise(F.col("status"))).select(*sessions.columns, "status")
    return outcomes, allowed_turns(turns, outcomes)


def allowed_turns(turns: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Turns of the sessions that a sync run lets through."""
    key = ["source", "session_id"]
    return turns.join(outcomes.filter("status = 'uploaded'").select(*key), key, "left_semi")


def search(queries: DataFrame, experiences: DataFrame, log: DataFrame, now: dt.datetime,
           k: int = se.TOP_K, task_type: str | None = None) -> dict[str, DataFrame]:
    """Personal, community and merged results with the quota of the asking owners."""
    quota = gv.quota(log, now)
    asking = queries.join(quota.select("owner", "community_unlocked"), "owner", "left").withColumn(
        "unlocked", F.coalesce("community_unlocked", F.lit(False))).drop("community_unlocked")
    personal = se.acl_filtered_search(asking, experiences, k, "personal", task_type)
    community = se.acl_filtered_search(asking, experiences, k, "community", task_type)
    return {"personal": personal, "community": community, "quota": quota,
            "results": se.merge_scopes(personal.drop("rank_no"), community.drop("rank_no"), k)}


def annotate_prompts(turns: DataFrame, strategy: str = "even", max_turns: int = 8, k: int = 4) -> DataFrame:
    """The table of prompts a judge answers outside."""
    pairs = pr.evaluable_pairs(turns)
    chosen = {"first": pr.select_turns_first, "even": pr.select_turns_even,
              "important": pr.select_turns_important}[strategy](pairs, max_turns)
    return pr.judge_input(turns, chosen, k)


def annotate_replies(replies: DataFrame, old: DataFrame | None = None) -> dict[str, DataFrame]:
    """Replies -> rewards (merged into the stored ones), failures and summaries."""
    rewards, failures = rw.validate_reward(replies)
    merged = rewards if old is None else rw.reward_upsert(old, rewards)
    return {"rewards": merged, "failures": failures, "summary": rw.reward_summary(merged)}
