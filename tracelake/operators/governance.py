"""Review routing, strict-public audit, publish, revoke, quota, dashboards, audit log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions.redact import has_high_severity
from tracelake.operators.scan import first_rows

QUOTA_THRESHOLD = 3
# What must not appear in a published row (name, pattern, severity).
STRICT_PUBLIC = (
    ("file_uri", r"file://[^\s\"'<>]+", "high"),
    ("ide_protocol", r"\bvscode-(?:resource|webview)://[^\s\"'<>]+", "high"),
    ("private_host", r"\b(?:localhost|127\.\d{1,3}\.\d{1,3}\.\d{1,3}|10\.\d{1,3}\.\d{1,3}\.\d{1,3}"
                     r"|192\.168\.\d{1,3}\.\d{1,3}|172\.(?:1[6-9]|2\d|3[01])\.\d{1,3}\.\d{1,3})\b", "medium"),
    ("absolute_path", r"/(?:Users|home|root|mnt|data|opt|var|srv|tmp|etc)/[^\s\"'<>]+", "medium"),
    ("uuid", r"\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\b", "medium"),
)


def review_routing(cards: DataFrame, verdicts: DataFrame | None = None,
                   key: str = "session_id") -> DataFrame:
    """No high-severity hit: approved at once. Otherwise pending, and the verdict, if there
    is one, says flagged (not sensitive) or human_review (sensitive)."""
    high = has_high_severity(F.col("redactions"))
    rows = cards.withColumn("_high", high)
    if verdicts is None:
        rows = rows.withColumn("_sensitive", F.lit(None).cast("boolean"))
    else:
        rows = rows.join(verdicts.select(key, F.col("is_sensitive").alias("_sensitive")), key, "left")
    return (rows.withColumn("review_status", F.when(F.col("_high"), "pending").otherwise("auto_approved"))
            .withColumn("sanitization_status", F.when(~F.col("_high") | F.col("_sensitive").isNull(), "layer1_only")
                        .when(F.col("_sensitive"), "human_review").otherwise("flagged"))
            .drop("_high", "_sensitive"))


def strict_public_audit(df: DataFrame, id_col: str, cols: list[str],
                        rules=STRICT_PUBLIC) -> DataFrame:
    """(id, column, name, match, severity), one row per hit; nothing is rewritten."""
    def hits_of(column: str, name: str, pattern: str, severity: str) -> Column:
        matches = F.regexp_extract_all(F.coalesce(F.col(column), F.lit("")), F.lit(pattern), 0)
        return F.transform(matches, lambda m: F.struct(
            F.lit(column).alias("column"), F.lit(name).alias("name"), m.alias("match"),
            F.lit(severity).alias("severity")))

    found = F.flatten(F.array(*[hits_of(c, *rule) for c in cols for rule in rules]))
    return df.select(id_col, F.explode(found).alias("h")).select(id_col, "h.*")


def blocked_ids(hits: DataFrame, id_col: str) -> DataFrame:
    return hits.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_hits"),
                                    F.min("name").alias("first_name"))


def publish(experiences: DataFrame, requests: DataFrame, text_cols: list[str]) -> DataFrame:
    """Every request (experience_id, owner) with its outcome: published, not_owner, revoked, blocked, or
    unknown for an id that is not stored. A requested row is audited once, whoever asks."""
    wanted = requests.select("experience_id").distinct()
    asked = experiences.join(wanted, "experience_id", "left_semi")
    hits = blocked_ids(strict_public_audit(asked, "experience_id", text_cols), "experience_id")
    found = asked.select("experience_id", "owner", "review_status").join(hits, "experience_id", "left")
    return requests.select("experience_id", F.col("owner").alias("caller")).join(found, "experience_id", "left").withColumn("result", (
        F.when(F.col("owner").isNull() & F.col("review_status").isNull(), "unknown")
         .when(~F.col("owner").eqNullSafe(F.col("caller")), "not_owner")
         .when(F.col("review_status") == "revoked", "revoked")
         .when(F.col("n_hits") > 0, "blocked").otherwise("published"))
    ).select("experience_id", "caller", "result", F.coalesce("n_hits", F.lit(0).cast("long")).alias("n_hits"))


def apply_publish(experiences: DataFrame, outcomes: DataFrame) -> DataFrame:
    done = outcomes.filter("result = 'published'").select("experience_id").distinct().withColumn("_p", F.lit(True))
    return (experiences.join(done, "experience_id", "left").withColumn(
        "publish_status", F.when(F.col("_p"), "published").otherwise(F.col("publish_status"))).drop("_p"))


def unpublish(experiences: DataFrame, requests: DataFrame) -> DataFrame:
    asked = requests.select("experience_id", "owner").distinct().withColumn("_u", F.lit(True))
    return (experiences.join(asked, ["experience_id", "owner"], "left").withColumn(
        "publish_status", F.when(F.col("_u") & (F.col("publish_status") == "published"), "unpublished")
        .otherwise(F.col("publish_status"))).drop("_u"))


def revoke(experiences: DataFrame, requests: DataFrame, now: dt.datetime) -> DataFrame:
    """Rows revoked by their owner lose their trajectory path and get the revoked status and
    time; a row revoked before keeps its time. The fingerprint ledger is left alone, so the
    same content stays known."""
    old = F.col("revoked_at") if "revoked_at" in experiences.columns else F.lit(None).cast("string")
    asked = requests.select("experience_id", "owner").distinct().withColumn("_r", F.lit(True))
    hit = F.coalesce(F.col("_r"), F.lit(False))
    return (experiences.join(asked, ["experience_id", "owner"], "left")
            .withColumn("revoked_at", F.coalesce(old, F.when(hit, F.date_format(F.lit(now), "yyyy-MM-dd'T'HH:mm:ss"))))
            .withColumn("trajectory_path", F.when(~hit, F.col("trajectory_path")))
            .withColumn("review_status", F.when(hit, "revoked").otherwise(F.col("review_status")))
            .drop("_r"))


def revoke_cascade(tables: dict[str, DataFrame], revoked: DataFrame) -> dict[str, DataFrame]:
    """Each dependent table without the rows of revoked experiences."""
    gone = revoked.select("experience_id").distinct()
    return {name: df.join(gone, "experience_id", "left_anti") for name, df in tables.items()}


def audit_rows(df: DataFrame, action: str, actor: str, target: str, now: dt.datetime) -> DataFrame:
    return df.select(F.lit(now).alias("ts"), F.col(actor).alias("actor"), F.lit("owner").alias("actor_kind"),
                     F.lit(action).alias("action"), F.col(target).alias("target_id"))


def audit_summary(log: DataFrame) -> DataFrame:
    return log.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "action").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("actor").alias("actors"))


def quota(log: DataFrame, now: dt.datetime, threshold: int = QUOTA_THRESHOLD) -> DataFrame:
    """Per owner: distinct rows published within a year. Publish events count, not the
    present state, so taking a row back does not lower it."""
    since = now - dt.timedelta(days=365)
    count = log.filter((F.col("action") == "publish") & (F.col("ts") >= F.lit(since)) & (F.col("ts") <= F.lit(now)))
    per = count.groupBy("actor").agg(F.count_distinct("target_id").alias("publish_count"))
    owners = log.select("actor").distinct()
    return owners.join(per, "actor", "left").select(
        F.col("actor").alias("owner"), F.coalesce("publish_count", F.lit(0).cast("long")).alias("publish_count"),
        F.lit(threshold).alias("threshold"),
        (F.coalesce("publish_count", F.lit(0)) >= threshold).alias("community_unlocked"))


def status_dashboard(experiences: DataFrame) -> DataFrame:
    return experiences.groupBy("sanitization_status").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("owner").alias("n_owners"))


def deep_queue_status(experiences: DataFrame) -> DataFrame:
    waiting = F.col("sanitization_status") == "layer1_only"
    return experiences.agg(
        F.count_if(waiting).alias("waiting"),
        F.count_if(F.col("sanitization_status") == "done").alias("done"),
        F.max(F.when(F.col("sanitization_status") == "done", F.col("deep_at"))).alias("last_run"))


def leaderboard(experiences: DataFrame) -> DataFrame:
    """Owners by published rows, then rows, densely ranked.

    Scores are made distinct first and ranked in two levels: inside one published count, and
    over the published counts. Different counts that add up to N rows number at most the
    square root of 2N, so neither level can grow large.
    """
    per = experiences.groupBy("owner").agg(
        F.count_if(F.col("publish_status") == "published").alias("n_published"),
        F.count(F.lit(1)).alias("n_rows"))
    scores = per.select("n_published", "n_rows").distinct()
    inside = scores.withColumn("_in", F.row_number().over(
        Window.partitionBy("n_published").orderBy(F.desc("n_rows"))))
    above = scores.groupBy("n_published").agg(F.count(F.lit(1)).alias("_n")).withColumn("_above", F.coalesce(
        F.sum("_n").over(Window.orderBy(F.desc("n_published")).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))).drop("_n")
    ranks = inside.join(above, "n_published").select(
        "n_published", "n_rows", (F.col("_above") + F.col("_in")).alias("rank_no"))
    return per.join(ranks, ["n_published", "n_rows"])


def sync_summary(outcomes: DataFrame) -> DataFrame:
    """Per source and in total: what a tick did with each session."""
    s = F.col("status")
    return outcomes.rollup("source").agg(
        F.count_if(s == "uploaded").alias("uploaded"), F.count_if(F.startswith(s, F.lit("skipped"))).alias("skipped"),
        F.count_if(s == "skipped_consent").alias("skipped_consent"),
        F.count_if(s == "failed").alias("failed"), F.count(F.lit(1)).alias("available_now")
    ).withColumn("source", F.coalesce("source", F.lit("*total*")))


def sync_state(outcomes: DataFrame) -> DataFrame:
    up = F.col("status") == "uploaded"
    return outcomes.groupBy("source").agg(
        F.count_distinct(F.when(up, F.col("session_id"))).alias("n_ids"),
        F.max(F.when(up, F.col("mtime"))).alias("last_mtime"), F.max("tick_at").alias("last_tick_at"))


def deep_pass(experiences: DataFrame, results: DataFrame, at: str) -> DataFrame:
    """Merge the deep pass: waiting rows with a result get its counts and become done; all
    others stay as they are, so running it again changes nothing."""
    res = results.groupBy("experience_id").agg(F.max("strict_redactions").alias("_res"))
    waiting = (F.col("sanitization_status") == "layer1_only") & F.col("_res").isNotNull()
    return (experiences.join(res, "experience_id", "left")
            .withColumn("strict_redactions", F.when(waiting, F.col("_res")).otherwise(F.col("strict_redactions")))
            .withColumn("deep_at", F.when(waiting, F.lit(at)).otherwise(F.col("deep_at")))
            .withColumn("sanitization_status", F.when(waiting, "done").otherwise(F.col("sanitization_status")))
            .drop("_res"))


def cap_per_source(files: DataFrame, n: int) -> DataFrame:
    """Oldest ``n`` sessions per source; rows are cut down before they meet."""
    return first_rows(files, ["source"], [F.col("mtime"), F.col("session_id")], n)


def latest_sessions(files: DataFrame, n: int) -> DataFrame:
    return files.orderBy(F.desc("mtime"), F.desc("session_id")).limit(n)


def oldest_unsynced(files: DataFrame, n: int) -> DataFrame:
    return files.orderBy("mtime", "session_id").limit(n)


def personal_recent(experiences: DataFrame, owner: str, n: int = 20) -> DataFrame:
    return experiences.filter(F.col("owner") == owner).orderBy(
        F.desc("created_at"), "experience_id").limit(n)

