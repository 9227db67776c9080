"""Publish, revoke, quota, dashboards, sync bookkeeping, audit; derived from orders, events and pages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tracelake.operators import governance as op
from tracelake.session import shared_dir
from tracelake.sources import hashed
from tracelake.suite.registry import case, q, table

NOW = dt.datetime(1998, 6, 1)

EXPERIENCES = """SELECT concat('x', CAST(o_orderkey AS STRING)) AS experience_id, o_orderkey, o_orderstatus, concat('o', CAST(o_custkey % 40 AS STRING)) AS owner,
 CASE o_orderkey % 6 WHEN 0 THEN 'done' WHEN 1 THEN 'flagged' WHEN 2 THEN 'human_review' ELSE 'layer1_only' END AS sanitization_status,
 CASE WHEN o_orderkey % 11 = 0 THEN 'revoked' ELSE 'auto_approved' END AS review_status,
 CASE o_orderkey % 4 WHEN 0 THEN 'published' WHEN 1 THEN 'unpublished' ELSE 'private' END AS publish_status,
 concat('traj/', CAST(o_orderkey AS STRING)) AS trajectory_path, CASE WHEN o_orderkey % 6 = 0 THEN 'name:1' END AS strict_redactions,
 CASE WHEN o_orderkey % 6 = 0 THEN CAST(5000000 + o_orderkey AS STRING) END AS deep_at FROM {orders}"""
EXP = "e AS (" + EXPERIENCES.format(orders="orders") + ")"
LOG = """SELECT o_orderdate AS ts, concat('o', CAST(o_custkey % 400 AS STRING)) AS actor, CASE o_orderkey % 3 WHEN 0 THEN 'publish' WHEN 1 THEN 'unpublish' ELSE 'push' END AS action,
 concat('x', CAST(o_orderkey % 5000 AS STRING)) AS target_id FROM {orders}"""
LOGC = "log AS (" + LOG.format(orders="orders") + ")"
REQUESTS = """SELECT concat('x', CAST(o_orderkey AS STRING)) AS experience_id, concat('o', CAST(CASE WHEN o_orderkey % 5 = 0 THEN o_custkey + 1 ELSE o_custkey END % 40 AS STRING)) AS owner
 FROM {orders} WHERE o_orderpriority = '1-URGENT'"""
REQ = "req AS (" + REQUESTS.format(orders="orders") + ")"
OUTCOMES = """SELECT concat('s', CAST(event_id AS STRING)) AS session_id, concat('src', CAST(user_id % 4 AS STRING)) AS source,
 CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'uploaded' WHEN 'click' THEN 'uploaded' ELSE CASE WHEN event_id % 2 = 0 THEN 'skipped_size' ELSE 'skipped_consent' END END AS status,
 event_id * 10 AS mtime, event_id % 50 AS tick_at FROM {events}"""
OUT = "oc AS (" + OUTCOMES.format(events="events") + ")"


def experiences(spark, sf):
    return spark.sql(EXPERIENCES, orders=table(spark, sf, "orders"))


def log(spark, sf):
    return spark.sql(LOG, orders=table(spark, sf, "orders"))


def requests(spark, sf):
    return spark.sql(REQUESTS, orders=table(spark, sf, "orders"))


def outcomes(spark, sf):
    return spark.sql(OUTCOMES, events=table(spark, sf, "events"))


@case("status_dashboard", f"WITH {EXP} SELECT sanitization_status, count(*) AS n_rows, count(DISTINCT owner) AS n_owners FROM e GROUP BY 1")
def status_dashboard(spark, sf):
    return op.status_dashboard(experiences(spark, sf))


@case("deep_queue_status", f"WITH {EXP} SELECT count(*) FILTER (sanitization_status = 'layer1_only') AS waiting, count(*) FILTER (sanitization_status = 'done') AS done, max(deep_at) AS last_run FROM e")
def deep_queue_status(spark, sf):
    return op.deep_queue_status(experiences(spark, sf))


@case("leaderboard", f"""WITH {EXP} SELECT owner, count(*) FILTER (publish_status = 'published') AS n_published, count(*) AS n_rows,
 dense_rank() OVER (ORDER BY count(*) FILTER (publish_status = 'published') DESC, count(*) DESC) AS rank_no FROM e GROUP BY owner""")
def leaderboard(spark, sf):
    return op.leaderboard(experiences(spark, sf))


@case("quota", f"""WITH {LOGC} SELECT actor AS owner, count(DISTINCT target_id) FILTER (action = 'publish' AND ts >= TIMESTAMP '1997-06-01' AND ts <= TIMESTAMP '1998-06-01') AS publish_count,
 3 AS threshold, count(DISTINCT target_id) FILTER (action = 'publish' AND ts >= TIMESTAMP '1997-06-01' AND ts <= TIMESTAMP '1998-06-01') >= 3 AS community_unlocked FROM log GROUP BY actor""")
def quota(spark, sf):
    return op.quota(log(spark, sf), NOW)


@case("audit_log", f"WITH {LOGC} SELECT strftime(ts, '%Y-%m-%d') AS day, action, count(*) AS n, count(DISTINCT actor) AS actors FROM log GROUP BY 1, 2")
def audit_log(spark, sf):
    return op.audit_summary(log(spark, sf))


@case("revoke", f"""WITH {EXP}, {REQ} SELECT e.experience_id, e.owner, CASE WHEN r.owner IS NULL THEN trajectory_path END AS trajectory_path,
 CASE WHEN r.owner IS NULL THEN review_status ELSE 'revoked' END AS review_status, CASE WHEN e.review_status = 'revoked' THEN '1997-01-01T00:00:00' WHEN r.owner IS NOT NULL THEN '1998-06-01T00:00:00' END AS revoked_at
 FROM e LEFT JOIN req r ON r.experience_id = e.experience_id AND r.owner = e.owner""")
def revoke(spark, sf):
    before = experiences(spark, sf).withColumn("revoked_at", F.when(F.col("review_status") == "revoked", "1997-01-01T00:00:00"))
    return op.revoke(before, requests(spark, sf), NOW).select(
        "experience_id", "owner", "trajectory_path", "review_status", "revoked_at")


@case("revoke_cascade", f"""WITH {REQ} SELECT concat('x', l_orderkey) AS experience_id, l_linenumber AS turn_index FROM lineitem
 WHERE concat('x', l_orderkey) NOT IN (SELECT experience_id FROM req)""")
def revoke_cascade(spark, sf):
    rewards = table(spark, sf, "lineitem").select(F.concat(F.lit("x"), F.col("l_orderkey").cast("string")).alias("experience_id"),
                                                  F.col("l_linenumber").alias("turn_index"))
    return op.revoke_cascade({"turn_rewards": rewards}, requests(spark, sf))["turn_rewards"]


@case("revoke_stored", f"""WITH {REQ} SELECT concat('x', l_orderkey) AS experience_id, l_linenumber AS turn_index FROM lineitem
 WHERE concat('x', l_orderkey) NOT IN (SELECT experience_id FROM req)""")
def revoke_stored(spark, sf):
    """The same on a stored table: only folders that hold a revoked key are written."""
    rewards = table(spark, sf, "lineitem").select(F.concat(F.lit("x"), F.col("l_orderkey").cast("string")).alias("experience_id"),
                                                  F.col("l_linenumber").alias("turn_index"))
    path = shared_dir(spark, "rewards")
    hashed.write_hashed(rewards, path, "experience_id")
    hashed.remove_hashed(spark, path, requests(spark, sf), "experience_id")
    return hashed.read_hashed(spark, path)


PUB = """SELECT concat('x', CAST(page_id AS STRING)) AS experience_id, concat('o', CAST(page_id % 9 AS STRING)) AS owner,
 CASE WHEN page_id % 13 = 0 THEN 'revoked' ELSE 'auto_approved' END AS review_status, 'private' AS publish_status, url,
 concat(html, CASE page_id % 4 WHEN 0 THEN ' see file:///Users/ann/x.txt' WHEN 1 THEN ' on 192.168.0.7' ELSE '' END) AS body FROM {pages}"""
PUB_REQ = ("SELECT concat('x', CAST(page_id AS STRING)) AS experience_id, concat('o', CAST(CASE WHEN page_id % 6 = 0 THEN 99 ELSE page_id % 9 END AS STRING)) AS owner FROM {pages} "
           "UNION ALL SELECT concat('y', CAST(page_id AS STRING)), 'o1' FROM {pages} WHERE page_id % 17 = 0 UNION ALL SELECT concat('x', CAST(page_id AS STRING)), 'o77' FROM {pages} WHERE page_id % 5 = 1")
HITS = " + ".join(f"len(regexp_extract_all(url, {q(p)})) + len(regexp_extract_all(body, {q(p)}))" for _n, p, _s in op.STRICT_PUBLIC)
PUB_SQL = f"""p AS ({PUB.format(pages='pages')}), pr AS ({PUB_REQ.format(pages='pages')}),
 res AS (SELECT pr.experience_id, pr.owner AS caller, CASE WHEN p.owner IS NULL THEN 'unknown' WHEN p.owner <> pr.owner THEN 'not_owner' WHEN review_status = 'revoked' THEN 'revoked'
 WHEN {HITS} > 0 THEN 'blocked' ELSE 'published' END AS result, CAST(coalesce({HITS}, 0) AS BIGINT) AS n_hits FROM pr LEFT JOIN p ON p.experience_id = pr.experience_id)"""


def published(spark, sf):
    return spark.sql(PUB, pages=table(spark, sf, "pages")), spark.sql(PUB_REQ, pages=table(spark, sf, "pages"))


@case("publish", f"WITH {PUB_SQL} SELECT * FROM res")
def publish(spark, sf):
    p, r = published(spark, sf)
    return op.publish(p, r, ["url", "body"])


@case("publish_apply", f"WITH {PUB_SQL} SELECT p.experience_id, CASE WHEN experience_id IN (SELECT experience_id FROM res WHERE result = 'published') THEN 'published' ELSE publish_status END AS publish_status FROM p")
def publish_apply(spark, sf):
    p, r = published(spark, sf)
    return op.apply_publish(p, op.publish(p, r, ["url", "body"])).select("experience_id", "publish_status")


@case("unpublish", f"""WITH {EXP}, {REQ} SELECT e.experience_id, CASE WHEN r.owner IS NOT NULL AND publish_status = 'published' THEN 'unpublished' ELSE publish_status END AS publish_status
 FROM e LEFT JOIN req r ON r.experience_id = e.experience_id AND r.owner = e.owner""")
def unpublish(spark, sf):
    return op.unpublish(experiences(spark, sf), requests(spark, sf)).select("experience_id", "publish_status")


@case("deep_pii_ledger", f"""WITH {EXP} SELECT experience_id, CASE WHEN sanitization_status = 'layer1_only' AND o_orderstatus = 'O' THEN 'done' ELSE sanitization_status END AS sanitization_status,
 CASE WHEN sanitization_status = 'layer1_only' AND o_orderstatus = 'O' THEN 'name:' || (o_orderkey % 5) ELSE strict_redactions END AS strict_redactions FROM e""")
def deep_pii_ledger(spark, sf):
    e = experiences(spark, sf)
    res = e.filter("o_orderstatus = 'O'").select("experience_id", F.concat(
        F.lit("name:"), (F.col("o_orderkey") % 5).cast("string")).alias("strict_redactions"))
    return op.deep_pass(e, res, "9000000").select("experience_id", "sanitization_status", "strict_redactions")


@case("sync_summary", f"""WITH {OUT} SELECT coalesce(source, '*total*') AS source, count(*) FILTER (status = 'uploaded') AS uploaded, count(*) FILTER (starts_with(status, 'skipped')) AS skipped,
 count(*) FILTER (status = 'skipped_consent') AS skipped_consent, count(*) FILTER (status = 'failed') AS failed, count(*) AS available_now FROM oc GROUP BY ROLLUP (source)""")
def sync_summary(spark, sf):
    return op.sync_summary(outcomes(spark, sf))


@case("sync_state", f"""WITH {OUT} SELECT source, count(DISTINCT session_id) FILTER (status = 'uploaded') AS n_ids, max(mtime) FILTER (status = 'uploaded') AS last_mtime, max(tick_at) AS last_tick_at FROM oc GROUP BY source""")
def sync_state(spark, sf):
    return op.sync_state(outcomes(spark, sf))
