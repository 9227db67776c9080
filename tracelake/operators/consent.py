"""Consent: path rules, overrides, agent rules, decision and gate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.schema import CONSENT_MODES

DEFAULT_MODE = "ask"
PENDING_TTL_DAYS, PENDING_MAX = 7, 100


def glob_regex(glob: Column) -> Column:
    """Anchored regular expression of a shell glob (``*`` and ``?`` cross slashes). Inside a
    class every character is itself, a range that runs backwards holds nothing, and a bracket
    that is not closed is a plain character."""
    def literal(c: Column) -> Column:
        return F.regexp_replace(c, r"([^A-Za-z0-9\s\x{80}-\x{10FFFF}])", r"\\$1")

    def inside(c: Column) -> Column:
        lo, hi = F.substring(c, 1, 1), F.substring(c, 3, 1)
        return F.when(F.length(c) < 3, literal(c)).when(lo > hi, "").otherwise(F.concat(literal(lo), F.lit("-"), literal(hi)))

    tokens = F.regexp_extract_all(glob, F.lit(r"(?s)\[!?\]?[^\]]*\]|."), F.lit(0))

    def regex(token: Column) -> Column:
        negated = F.startswith(token, F.lit("[!"))
        body = F.substr(token, F.when(negated, 3).otherwise(2), F.length(token) - F.when(negated, 3).otherwise(2))
        members = F.array_join(F.transform(F.regexp_extract_all(body, F.lit("(?s).-.|."), F.lit(0)), inside), "")
        cls = F.when(members != "", F.concat(F.when(negated, "[^").otherwise("["), members, F.lit("]"))).when(negated, ".").otherwise("(?!)")
        return F.when(F.length(token) > 1, cls).when(token == "*", ".*").when(token == "?", ".").otherwise(literal(token))

    return F.concat(F.lit(r"(?s)\A"), F.array_join(F.transform(tokens, regex), ""), F.lit(r"\z"))


def _anchor(glob: Column) -> Column:
    """The folder every match of the glob lies in: text before the first wildcard, cut at
    its last slash. ``**`` rules also match their own folder."""
    deep = F.contains(glob, F.lit("**"))
    literal = F.regexp_extract(glob, r"^[^*?\[]*", 0)
    folder = F.regexp_replace(literal, r"/?[^/]*$", "")
    prefix = F.rtrim(F.regexp_extract(glob, r"^(.*?)\*\*", 1), F.lit("/"))
    return F.when(deep, prefix).otherwise(folder)


def _ancestors(path: Column) -> Column:
    """The path, every folder above it, and the empty root."""
    parts = F.split(path, "/")
    return F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")))


def glob_matches(paths: DataFrame, rules: DataFrame) -> DataFrame:
    """(cwd, pos, glob, mode) of every rule that matches a distinct path.

    The anchor folder of a rule is an ancestor of every path it matches, so rules and paths
    meet in an equi-join; only then the pattern is tried. No nested-loop join.
    """
    cwd = paths.select("cwd").distinct()
    up = cwd.select("cwd", F.explode(_ancestors(F.col("cwd"))).alias("anchor"))
    keyed = (rules.filter("glob <> ''").filter(F.col("mode").isin(*CONSENT_MODES))
             .select("pos", "glob", "mode", _anchor(F.col("glob")).alias("anchor"),
                     F.contains("glob", F.lit("**")).alias("deep"),
                     glob_regex(F.col("glob")).alias("pattern")))
    hit = F.col("deep") | F.expr("cwd RLIKE pattern")
    return up.join(keyed, "anchor").filter(hit).select("cwd", "pos", "glob", "mode")


def live_overrides(overrides: DataFrame, now: dt.datetime) -> DataFrame:
    """Overrides that expire later than ``now``; a malformed time drops the row, a time
    without zone is UTC."""
    raw = F.col("expires_at")
    zoned = F.when(F.rlike(raw, F.lit(r"(Z|[+-]\d\d:?\d\d)$")), raw).otherwise(F.concat(raw, F.lit("Z")))
    return overrides.filter(F.try_to_timestamp(zoned) > F.lit(now))


expire_overrides = live_overrides


def agent_rule_join(sessions: DataFrame, agent_rules: DataFrame) -> DataFrame:
    """Sessions with the mode of their agent's rule (NULL without one)."""
    rules = agent_rules.groupBy("agent").agg(F.max_by("mode", "mode").alias("agent_mode"))
    return sessions.join(rules, "agent", "left")


def consent_decide(sessions: DataFrame, overrides: DataFrame, cwd_rules: DataFrame,
                   agent_rules: DataFrame, global_mode: str | None, now: dt.datetime,
                   never_is_absolute: bool = False) -> DataFrame:
    """Sessions (session_id, agent, cwd) with ``mode`` and ``reason``.

    A live session override answers first. Else any 'never' among the path rules, the agent
    rule and the global mode wins; else the first of them in that order. Path rules are
    settled once per distinct folder and joined back by equality.
    """
    matched = glob_matches(sessions, cwd_rules).groupBy("cwd").agg(
        F.min(F.struct("pos", "mode", "glob")).alias("first_rule"),
        F.min(F.when(F.col("mode") == "never", F.struct("pos", "mode", "glob"))).alias("never_rule"))
    live = (live_overrides(overrides, now).filter(F.col("mode").isin(*CONSENT_MODES))
            .groupBy("session_id").agg(F.max_by("mode", "expires_at").alias("override_mode")))
    agents = (agent_rules.filter(F.col("mode").isin(*CONSENT_MODES)).groupBy("agent")
              .agg(F.max("mode").alias("agent_mode")))
    top = global_mode if global_mode in CONSENT_MODES else DEFAULT_MODE
    rows = (sessions.join(matched, "cwd", "left").join(agents, "agent", "left")
            .join(live, "session_id", "left"))

    def rule(r: str) -> Column:
        return F.concat(F.lit("cwd_rule:"), F.col(f"{r}.glob"))

    agent_reason = F.concat(F.lit("agent:"), "agent")
    never = F.col("never_rule").isNotNull() | F.coalesce(F.col("agent_mode") == "never", F.lit(False)) | F.lit(top == "never")
    never_reason = (F.when(F.col("never_rule").isNotNull(), rule("never_rule"))
                     .when(F.col("agent_mode") == "never", agent_reason).otherwise("global"))
    use_override = F.col("override_mode").isNotNull()
    if never_is_absolute:
        use_override = use_override & ~never
    mode = (F.when(use_override, F.col("override_mode")).when(never, "never")
             .otherwise(F.coalesce("first_rule.mode", "agent_mode", F.lit(top))))
    reason = (F.when(use_override, "session_override").when(never, never_reason)
               .when(F.col("first_rule").isNotNull(), rule("first_rule"))
               .when(F.col("agent_mode").isNotNull(), agent_reason).otherwise("global"))
    return rows.select(*sessions.columns, mode.alias("mode"), reason.alias("reason"))


def consent_gate(decisions: DataFrame, force: bool = False, dry_run: bool = False) -> DataFrame:
    """Decision to action: ``allow`` and ``gate_reason``. Nobody can be asked in a batch, so
    'ask' and 'prompt-on-start' end like an unanswered prompt: not allowed."""
    mode = F.col("mode")
    if dry_run:
        return decisions.withColumn("allow", F.lit(True)).withColumn("gate_reason", F.lit("dry_run"))
    allow = (mode != "never") & ((mode == "always") | F.lit(force))
    why = (F.when(mode == "never", F.concat(F.lit("never ("), "reason", F.lit(")")))
            .when(allow, mode).when(mode == "dry-run", "dry-run mode (saved to pending/)")
            .otherwise("user_no"))
    return decisions.withColumn("allow", allow).withColumn("gate_reason", why)


def no_policy_gate(sessions: DataFrame) -> DataFrame:
    """Without policy tables nothing passes."""
    return sessions.withColumn("allow", F.lit(False)).withColumn("gate_reason", F.lit("no policy"))


def default_acl(sessions: DataFrame, agent_rules: DataFrame, explicit: str | None = None,
                backfill: bool = False) -> DataFrame:
    """Access of a new row: explicit choice, else the agent's default, else private; bulk
    imports are always private."""
    if backfill:
        return sessions.withColumn("acl", F.lit("private"))
    if explicit is not None:
        return sessions.withColumn("acl", F.lit(explicit))
    rules = agent_rules.groupBy("agent").agg(F.max("default_acl").alias("_acl"))
    return (sessions.join(rules, "agent", "left")
            .withColumn("acl", F.coalesce(F.nullif("_acl", F.lit("")), F.lit("private"))).drop("_acl"))


def prune_pending(pending: DataFrame, now: dt.datetime, ttl_days: int = PENDING_TTL_DAYS,
                  max_entries: int = PENDING_MAX) -> DataFrame:
    """Entries younger than the limit, newest ``max_entries`` of them (a distributed top-n)."""
    cutoff = now - dt.timedelta(days=ttl_days)
    return (pending.filter(F.col("saved_at") >= F.lit(cutoff))
            .orderBy(F.desc("saved_at"), F.desc("session_id")).limit(max_entries))


def policy_tables(spark: SparkSession, policy: dict) -> tuple[DataFrame, DataFrame, DataFrame, str | None]:
    """(overrides, cwd_rules, agent_rules, global mode) of a policy document."""
    for mode in [policy.get("mode", DEFAULT_MODE), *[r["mode"] for r in policy.get("cwd_rules", [])],
                 *[a["mode"] for a in policy.get("agents", {}).values()]]:
        if mode not in CONSENT_MODES:
            raise ValueError(f"invalid consent mode {mode!r}")
    over = [(s, o["mode"], o.get("expires_at", "")) for s, o in policy.get("session_overrides", {}).items()]
    cwds = [(i, r["glob"], r["mode"], r.get("reason", "")) for i, r in enumerate(policy.get("cwd_rules", []))]
    agents = [(a, r["mode"], r.get("default_acl", ""), r.get("comment", ""))
              for a, r in policy.get("agents", {}).items()]
    return (spark.createDataFrame(over, "session_id string, mode string, expires_at string"),
            spark.createDataFrame(cwds, "pos int, glob string, mode string, reason string"),
            spark.createDataFrame(agents, "agent string, mode string, default_acl string, comment string"),
            policy.get("mode", DEFAULT_MODE))
