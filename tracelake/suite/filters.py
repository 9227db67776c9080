"""Filters, session metadata, tool links, listings, chat tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.functions import text as tx
from tracelake.operators import dedup as dd
from tracelake.operators import filters as op
from tracelake.operators import governance as gv
from tracelake.suite.cards import (
    BF_ASSISTANT, BF_USER, FINGERPRINT_CTE, REAL_ASSISTANT, REAL_USER, strip_sql,
)
from tracelake.suite.registry import case, table, turns, turns_cte

ROLE_IN = ("concat(CASE turn % 4 WHEN 0 THEN ' ' ELSE '' END, CASE (conv_id + turn) % 8 WHEN 0 THEN 'Human' WHEN 1 THEN 'AI' WHEN 2 THEN 'bot' "
           "WHEN 3 THEN 'function' WHEN 4 THEN 'critic' WHEN 5 THEN 'System' WHEN 6 THEN '' ELSE role END)")
NAME_IN = "CASE WHEN conv_id % 2 = 0 THEN 'planner' ELSE '' END"


@case("coerce_role", f"""SELECT conv_id, turn, CASE WHEN r IN ('user', 'human') THEN 'user' WHEN r IN ('assistant', 'ai', 'bot', 'agent') THEN 'assistant'
  WHEN r = 'system' THEN 'system' WHEN r IN ('tool', 'function') THEN 'tool' WHEN n <> '' THEN 'assistant' ELSE 'user' END AS role
  FROM (SELECT conv_id, turn, trim(lower({ROLE_IN})) AS r, {NAME_IN} AS n FROM conversations)""")
def coerce_role(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", tx.coerce_role(F.expr(ROLE_IN), F.expr(NAME_IN)).alias("role"))


SOME_BLANK = "CASE WHEN turn_index % 6 = 2 THEN ' ' WHEN role = 'user' AND conv_id % 5 = 0 THEN concat('[Request interrupted by user] ', content) ELSE content END"


def spotty(spark, sf):
    return turns(spark, sf).withColumn("content", F.expr(SOME_BLANK))


SPOTTY = f"{turns_cte()}, spotty AS (SELECT * EXCLUDE (content), {SOME_BLANK} AS content FROM turns)"


@case("drop_blank_turns", f"WITH {SPOTTY} SELECT session_id, turn_index FROM spotty WHERE {strip_sql('content')} <> '' OR call_id <> ''")
def drop_blank_turns(spark, sf):
    return op.drop_blank_turns(spotty(spark, sf)).select("session_id", "turn_index")


@case("interrupt_filter", f"WITH {SPOTTY} SELECT session_id, turn_index FROM spotty WHERE NOT (role = 'user' AND starts_with(content, '[Request interrupted'))")
def interrupt_filter(spark, sf):
    return op.interrupt_filter(spotty(spark, sf)).select("session_id", "turn_index")


KIND = "CASE event_id % 9 WHEN 0 THEN 'summary' WHEN 1 THEN 'attachment' WHEN 2 THEN 'permission-mode' WHEN 3 THEN 'queue-operation' ELSE event_type END"


@case("meta_type_filter", f"SELECT event_id, t AS type FROM (SELECT event_id, {KIND} AS t FROM events) WHERE t NOT IN ('summary', 'attachment', 'permission-mode', 'queue-operation')")
def meta_type_filter(spark, sf):
    return op.meta_type_filter(table(spark, sf, "events").select("event_id", F.expr(KIND).alias("type")))


WRAPPED = ("concat(CASE (conv_id + turn_index) % 9 WHEN 0 THEN ' <environment_context>' WHEN 1 THEN '<command-name>' WHEN 2 THEN '💭 ' "
           "WHEN 3 THEN '[note] ' WHEN 4 THEN '🔧 ' ELSE '' END, content)")


@case("is_real_user", f"WITH {turns_cte()} SELECT session_id, turn_index, {REAL_USER} AS main, {REAL_ASSISTANT} AS main_assistant, {BF_USER} AS backfill, "
                      f"{BF_ASSISTANT} AS backfill_assistant FROM (SELECT *, {WRAPPED} AS txt FROM turns)")
def is_real_user(spark, sf):
    t = turns(spark, sf)
    r, c = F.col("role"), F.expr(WRAPPED)
    return t.select("session_id", "turn_index", tx.is_real_user(r, c).alias("main"),
                    tx.is_real_assistant(r, c).alias("main_assistant"), tx.is_backfill_user(r, c).alias("backfill"),
                    tx.is_backfill_assistant(r, c).alias("backfill_assistant"))


PACKED = "CASE WHEN conv_id % 5 = 2 AND role = 'user' THEN concat(' <transcript>', content) ELSE content END"


@case("artifact_filter", f"""WITH {turns_cte()}, p AS (SELECT * EXCLUDE (content), {PACKED} AS content FROM turns)
 SELECT session_id, turn_index FROM p WHERE session_id NOT IN (SELECT session_id FROM p WHERE role = 'user' GROUP BY session_id
 HAVING starts_with(ltrim(arg_min(content, turn_index)), '<transcript>'))""")
def artifact_filter(spark, sf):
    return op.artifact_filter(turns(spark, sf).withColumn("content", F.expr(PACKED))).select("session_id", "turn_index")


# --- a session listing derived from the conversations --------------------------------------

FILES_SQL = f"""SELECT concat('s', CAST(conv_id AS STRING)) AS session_id, concat('src', CAST(conv_id % 3 AS STRING)) AS source,
  sum(length(text)) * 100 AS size_bytes, {{stamp}} AS mtime FROM {{conversations}} GROUP BY conv_id"""
FILES_DUCK = FILES_SQL.format(stamp="strftime(make_timestamp(CAST(1704067200 + (conv_id * 7919) % 100000 AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%S')",
                              conversations="conversations").replace("sum(length(text)) * 100", "CAST(sum(length(text)) * 100 AS BIGINT)")


def files(spark, sf):
    sql = FILES_SQL.format(stamp="date_format(timestamp_seconds(1704067200 + (conv_id * 7919) % 100000), \"yyyy-MM-dd'T'HH:mm:ss\")",
                           conversations="{conversations}")
    return spark.sql(sql, conversations=table(spark, sf, "conversations"))


@case("size_cap_filter", f"SELECT * FROM ({FILES_DUCK}) WHERE size_bytes <= 300 * 1024")
def size_cap_filter(spark, sf):
    return op.size_cap_filter(files(spark, sf), 300)


@case("since_filter", f"SELECT * FROM ({FILES_DUCK}) WHERE mtime >= '2024-01-01T12:00:00'")
def since_filter(spark, sf):
    return op.since_filter(files(spark, sf), "2024-01-01T12:00:00")


@case("cap_per_source", f"SELECT * FROM ({FILES_DUCK}) QUALIFY row_number() OVER (PARTITION BY source ORDER BY mtime, session_id) <= 10")
def cap_per_source(spark, sf):
    return gv.cap_per_source(files(spark, sf), 10)


@case("latest_sessions", f"SELECT * FROM ({FILES_DUCK}) ORDER BY mtime DESC, session_id DESC LIMIT 25")
def latest_sessions(spark, sf):
    return gv.latest_sessions(files(spark, sf), 25)


@case("oldest_unsynced", f"SELECT * FROM ({FILES_DUCK}) ORDER BY mtime, session_id LIMIT 25")
def oldest_unsynced(spark, sf):
    return gv.oldest_unsynced(files(spark, sf), 25)


@case("seen_id_antijoin", f"SELECT f.* FROM ({FILES_DUCK}) f WHERE NOT EXISTS (SELECT 1 FROM customer WHERE f.session_id = 's' || (c_custkey * 3) AND f.source = 'src' || ((c_custkey * 3) % 3))")
def seen_id_antijoin(spark, sf):
    seen = table(spark, sf, "customer").select(
        F.concat(F.lit("src"), (F.col("c_custkey") * 3 % 3).cast("string")).alias("source"),
        F.concat(F.lit("s"), (F.col("c_custkey") * 3).cast("string")).alias("session_id"))
    return dd.seen_id_antijoin(files(spark, sf), seen)


@case("merge_seen_ids", """WITH both_sides AS (SELECT 'src' || (user_id % 3) AS source, 'e' || (event_id % 7000) AS session_id, event_id AS seen_at FROM events)
 SELECT * FROM (SELECT source, session_id, max(seen_at) AS seen_at FROM both_sides GROUP BY 1, 2)
 QUALIFY row_number() OVER (PARTITION BY source ORDER BY seen_at DESC, session_id DESC) <= 1500""")
def merge_seen_ids(spark, sf):
    e = table(spark, sf, "events").select(
        F.concat(F.lit("src"), (F.col("user_id") % 3).cast("string")).alias("source"),
        F.concat(F.lit("e"), (F.col("event_id") % 7000).cast("string")).alias("session_id"),
        F.col("event_id").alias("seen_at"))
    return dd.merge_seen_ids(e.filter("seen_at % 2 = 0"), e.filter("seen_at % 2 = 1"), 1500)


EVENT_ROWS = """SELECT concat('u', CAST(user_id AS STRING)) AS session_id, event_id AS line_no,
  CASE WHEN event_id % 4 = 0 THEN '' ELSE CAST(1000000 + event_id AS STRING) END AS ts,
  CASE WHEN event_id % 3 = 0 THEN concat('1.', CAST(event_id % 10 AS STRING)) ELSE '' END AS version,
  CASE WHEN event_type = 'view' THEN concat('/work/', CAST(event_id % 5 AS STRING)) ELSE '' END AS cwd,
  CASE WHEN event_id % 7 = 0 THEN '<synthetic>' WHEN event_id % 5 = 0 THEN concat('model-', CAST(event_id % 3 AS STRING)) ELSE '' END AS model
  FROM {events}"""


@case("session_meta", f"""WITH e AS ({EVENT_ROWS.format(events='events')})
 SELECT session_id, coalesce(arg_min(ts, line_no) FILTER (ts <> ''), '') AS started_at, coalesce(arg_max(ts, line_no) FILTER (ts <> ''), '') AS ended_at,
  coalesce(arg_max(version, line_no) FILTER (version <> ''), '') AS agent_version, coalesce(arg_max(cwd, line_no) FILTER (cwd <> ''), '') AS cwd,
  coalesce(arg_max(model, line_no) FILTER (model NOT IN ('', '<synthetic>')), 'unknown') AS model FROM e GROUP BY session_id""")
def session_meta(spark, sf):
    return op.session_meta(spark.sql(EVENT_ROWS, events=table(spark, sf, "events")))


@case("tool_link", f"""WITH {turns_cte()} SELECT c.session_id, c.call_id, min(c.tool_name) AS name, count(DISTINCT c.turn_index) AS n_calls,
  count(DISTINCT r.turn_index) AS n_results FROM (SELECT * FROM turns WHERE call_id <> '') c LEFT JOIN turns r
  ON r.session_id = c.session_id AND r.tool_result_for = c.call_id GROUP BY ALL""")
def tool_link(spark, sf):
    return op.tool_link(turns(spark, sf))


@case("block_census", f"""WITH {turns_cte()} SELECT session_id, count(*) AS n_turns, count(*) FILTER (role = 'user') AS n_user,
  count(*) FILTER (role = 'assistant') AS n_assistant, count(*) FILTER (role = 'system') AS n_system, count(*) FILTER (role = 'tool') AS n_tool,
  count(*) FILTER (call_id <> '') AS n_calls FROM turns GROUP BY session_id""")
def block_census(spark, sf):
    return op.block_census(turns(spark, sf))


# --- fingerprints: copies are made by giving two agents the same conversations ---------------

PRINTS = f"""{turns_cte()}, {FINGERPRINT_CTE},
prints AS (SELECT 'a' || (CAST(substring(session_id, 2) AS BIGINT) % 4) AS agent_id, session_id || '-' || k AS session_id, fingerprint,
  CAST(substring(session_id, 2) AS BIGINT) * 10 + k AS arrival FROM fp, range(3) r(k)
  WHERE k = 0 OR CAST(substring(session_id, 2) AS BIGINT) % (k + 1) = 0)"""


def prints(spark, sf):
    from tracelake.operators.cards import fingerprint
    no = F.substring("session_id", 2, 20).cast("long")
    return (fingerprint(turns(spark, sf)).withColumn("n", no)
            .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(2))))
            .filter("k = 0 OR n % (k + 1) = 0")
            .select(F.concat(F.lit("a"), (F.col("n") % 4).cast("string")).alias("agent_id"),
                    F.concat("session_id", F.lit("-"), F.col("k").cast("string")).alias("session_id"),
                    "fingerprint", (F.col("n") * 10 + F.col("k")).alias("arrival")))


@case("dedup_sessions", f"WITH {PRINTS} SELECT agent_id, fingerprint, arg_min(session_id, arrival) AS session_id, min(arrival) AS arrival, count(*) AS n_copies FROM prints GROUP BY 1, 2")
def dedup_sessions(spark, sf):
    return dd.dedup_clusters(prints(spark, sf))


@case("duplicate_report", f"""WITH {PRINTS}, k AS (SELECT agent_id, fingerprint, arg_min(session_id, arrival) AS kept_id FROM prints GROUP BY 1, 2)
 SELECT p.session_id, p.agent_id, p.fingerprint, kept_id FROM prints p JOIN k USING (agent_id, fingerprint) WHERE p.session_id <> kept_id""")
def duplicate_report(spark, sf):
    return dd.duplicates(prints(spark, sf))


LEDGER = "ledger AS (SELECT agent_id, fingerprint, 'x-' || session_id AS experience_id FROM prints WHERE agent_id IN ('a0', 'a1'))"


def ledger(p):
    return p.filter("agent_id IN ('a0', 'a1')").select("agent_id", "fingerprint", F.concat(F.lit("x-"), "session_id").alias("experience_id"))


@case("dedup_ledger_antijoin", f"""WITH {PRINTS}, {LEDGER} SELECT agent_id, fingerprint, arg_min(session_id, arrival) AS session_id, min(arrival) AS arrival FROM prints p
 WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.agent_id = p.agent_id AND l.fingerprint = p.fingerprint) GROUP BY 1, 2""")
def dedup_ledger_antijoin(spark, sf):
    p = prints(spark, sf)
    return dd.dedup_ledger_antijoin(p, ledger(p))[0]


@case("dedup_ledger_known", f"WITH {PRINTS}, {LEDGER} SELECT p.session_id, p.agent_id, p.fingerprint, experience_id FROM prints p JOIN (SELECT agent_id, fingerprint, min(experience_id) AS experience_id FROM ledger GROUP BY 1, 2) l USING (agent_id, fingerprint)")
def dedup_ledger_known(spark, sf):
    p = prints(spark, sf)
    return dd.dedup_ledger_antijoin(p, ledger(p))[1]


@case("session_end_repush", f"""WITH {PRINTS}, pu AS (SELECT agent_id, split_part(session_id, '-', 1) AS session_id, fingerprint, arrival AS push_no FROM prints)
 SELECT agent_id, session_id, fingerprint, min(push_no) AS push_no, count(*) AS n_pushes FROM pu GROUP BY 1, 2, 3""")
def session_end_repush(spark, sf):
    p = prints(spark, sf).select("agent_id", F.substring_index("session_id", "-", 1).alias("session_id"),
                                 "fingerprint", F.col("arrival").alias("push_no"))
    return dd.session_end_repush(p)
