"""Consent rules and decisions over derived sessions; rules are derived from given tables."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from tracelake.operators import consent as op
from tracelake.operators import dedup as dd
from tracelake.suite.registry import case, table

def quoted(sql: str) -> str:
    """``glob`` is a keyword of the check engine."""
    return re.sub(r"\bglob\b", '"glob"', sql)


NOW = dt.datetime(2024, 1, 15, 12, 0, 0)
NOW_SQL = "TIMESTAMP '2024-01-15 12:00:00'"

SESSIONS = """SELECT concat('s', CAST(event_id AS STRING)) AS session_id, concat('agent', CAST(user_id % 5 AS STRING)) AS agent,
 concat('/home/user', CAST(user_id % 12 AS STRING), CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN '/work' WHEN 2 THEN concat('/work/p', CAST(user_id % 3 AS STRING)) ELSE '/tmp.d/x' END) AS cwd
 FROM {events}"""
RULES = """SELECT CAST(n_nationkey AS INT) AS pos, CASE WHEN n_nationkey < 12 THEN CASE n_nationkey % 3
  WHEN 0 THEN concat('/home/user', CAST(n_nationkey AS STRING), '/work/**') WHEN 1 THEN concat('/home/user', CAST(n_nationkey AS STRING), '/w*')
  ELSE concat('/home/user', CAST(n_nationkey AS STRING)) END WHEN n_nationkey < 20 THEN concat('/*/user', CAST(n_nationkey - 10 AS STRING), '/tmp.?/x')
  ELSE concat('*p', CAST(n_nationkey - 20 AS STRING)) END AS glob,
  CASE n_nationkey % 5 WHEN 0 THEN 'always' WHEN 1 THEN 'ask' WHEN 2 THEN 'never' WHEN 3 THEN 'dry-run' ELSE 'always' END AS mode, n_name AS reason FROM {nation}"""
OVERRIDES = """SELECT concat('s', CAST(event_id * 3 AS STRING)) AS session_id, CASE WHEN event_id % 3 = 0 THEN 'always' WHEN event_id % 3 = 1 THEN 'never' ELSE 'ask' END AS mode,
  CASE event_id % 5 WHEN 0 THEN 'soon' WHEN 1 THEN '2024-01-15T11:00:00' WHEN 2 THEN '2024-01-15T15:00:00+02:00' WHEN 3 THEN '2024-02-01T00:00:00Z' ELSE '2024-01-15T12:30:00' END AS expires_at
  FROM {events} WHERE event_type = 'error'"""
AGENTS = """SELECT concat('agent', CAST(r_regionkey AS STRING)) AS agent, CASE r_regionkey WHEN 0 THEN 'always' WHEN 1 THEN 'never' ELSE 'prompt-on-start' END AS mode,
  CASE WHEN r_regionkey = 3 THEN 'team:blue' WHEN r_regionkey = 2 THEN 'public' ELSE '' END AS default_acl FROM {region} WHERE r_regionkey < 4"""

BASE = ("sessions AS (" + SESSIONS.format(events="events") + "), rules AS (" + RULES.format(nation="nation") + "), ov AS ("
        + OVERRIDES.format(events="events") + "), agents AS (" + AGENTS.format(region="region") + f"""),
hits AS (SELECT DISTINCT s.cwd, r.* FROM (SELECT DISTINCT cwd FROM sessions) s JOIN rules r ON CASE WHEN contains(glob, '**')
  THEN cwd = rtrim(split_part(glob, '**', 1), '/') OR starts_with(cwd, rtrim(split_part(glob, '**', 1), '/') || '/') ELSE
  regexp_full_match(cwd, replace(replace(replace(glob, '.', '\\.'), '*', '.*'), '?', '.')) END),
live AS (SELECT * FROM (SELECT session_id, mode, TRY_CAST(CASE WHEN regexp_matches(expires_at, '(Z|[+-]\\d\\d:?\\d\\d)$') THEN expires_at ELSE expires_at || 'Z' END AS TIMESTAMPTZ) AS e FROM ov)
  WHERE e > TIMESTAMPTZ '2024-01-15 12:00:00+00'),
decided AS (SELECT s.session_id, s.agent, s.cwd, l.mode AS lm, a.mode AS am,
  (SELECT arg_min(h.mode, h.pos) FROM hits h WHERE h.cwd = s.cwd) AS fm, (SELECT arg_min(h.glob, h.pos) FROM hits h WHERE h.cwd = s.cwd) AS fg,
  (SELECT arg_min(h.glob, h.pos) FROM hits h WHERE h.cwd = s.cwd AND h.mode = 'never') AS ng
  FROM sessions s LEFT JOIN live l USING (session_id) LEFT JOIN agents a USING (agent)),
decision AS (SELECT session_id, agent, cwd, CASE WHEN lm IS NOT NULL THEN lm WHEN ng IS NOT NULL OR am = 'never' THEN 'never' ELSE coalesce(fm, am, 'ask') END AS mode,
  CASE WHEN lm IS NOT NULL THEN 'session_override' WHEN ng IS NOT NULL THEN 'cwd_rule:' || ng WHEN am = 'never' THEN 'agent:' || agent
  WHEN fm IS NOT NULL THEN 'cwd_rule:' || fg WHEN am IS NOT NULL THEN 'agent:' || agent ELSE 'global' END AS reason FROM decided)""")


def sessions(spark, sf):
    return spark.sql(SESSIONS, events=table(spark, sf, "events"))


def rules(spark, sf):
    return spark.sql(RULES, nation=table(spark, sf, "nation"))


def overrides(spark, sf):
    return spark.sql(OVERRIDES, events=table(spark, sf, "events"))


def agents(spark, sf):
    return spark.sql(AGENTS, region=table(spark, sf, "region"))


def decide(spark, sf):
    return op.consent_decide(sessions(spark, sf), overrides(spark, sf), rules(spark, sf), agents(spark, sf), "ask", NOW)


@case("consent_glob_join", quoted(f"WITH {BASE} SELECT cwd, pos, glob, mode FROM hits"))
def consent_glob_join(spark, sf):
    return op.glob_matches(sessions(spark, sf), rules(spark, sf))


@case("consent_equi_join", quoted(f"WITH {BASE} SELECT s.session_id, s.agent, s.cwd, a.mode AS agent_mode FROM sessions s LEFT JOIN agents a USING (agent)"))
def consent_equi_join(spark, sf):
    return op.agent_rule_join(sessions(spark, sf), agents(spark, sf))


@case("expire_overrides", quoted(f"WITH {BASE} SELECT session_id, mode FROM live"))
def expire_overrides(spark, sf):
    return op.expire_overrides(overrides(spark, sf), NOW.replace(tzinfo=dt.timezone.utc)).select("session_id", "mode")


@case("consent_decide", quoted(f"WITH {BASE} SELECT * FROM decision"))
def consent_decide(spark, sf):
    return decide(spark, sf)


@case("consent_gate", quoted(f"""WITH {BASE} SELECT session_id, mode = 'always' AS allow, CASE WHEN mode = 'never' THEN 'never (' || reason || ')'
  WHEN mode = 'always' THEN mode WHEN mode = 'dry-run' THEN 'dry-run mode (saved to pending/)' ELSE 'user_no' END AS gate_reason FROM decision"""))
def consent_gate(spark, sf):
    return op.consent_gate(decide(spark, sf)).select("session_id", "allow", "gate_reason")


@case("default_acl", quoted(f"WITH {BASE} SELECT session_id, agent, cwd, coalesce(nullif(default_acl, ''), 'private') AS acl FROM sessions LEFT JOIN agents USING (agent)"))
def default_acl(spark, sf):
    return op.default_acl(sessions(spark, sf), agents(spark, sf))


@case("prune_pending", quoted(f"""SELECT session_id, saved_at FROM (SELECT 'e' || event_id AS session_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS saved_at, ts FROM events
  WHERE ts >= {NOW_SQL} - INTERVAL 7 DAY) ORDER BY ts DESC, session_id DESC LIMIT 100"""))
def prune_pending(spark, sf):
    p = table(spark, sf, "events").select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("session_id"),
                                          F.col("ts").alias("saved_at"))
    return op.prune_pending(p, NOW).select("session_id", F.date_format("saved_at", "yyyy-MM-dd HH:mm:ss").alias("saved_at"))


NEW_RULES = "SELECT CAST(100 + n_nationkey AS INT) AS pos, CONCAT(glob, CASE WHEN n_nationkey % 2 = 0 THEN '' ELSE 'x' END) AS glob, 'never' AS mode, 'new' AS reason FROM {rules} r JOIN {nation} n ON r.pos = n.n_nationkey"


@case("replace_rule", quoted(f"WITH {BASE}, new AS ({NEW_RULES.format(rules='rules', nation='nation')}) SELECT * FROM rules WHERE glob NOT IN (SELECT glob FROM new) UNION ALL SELECT * FROM new"))
def replace_rule(spark, sf):
    r = rules(spark, sf)
    return dd.replace_rule(r, spark.sql(NEW_RULES, rules=r, nation=table(spark, sf, "nation")))
