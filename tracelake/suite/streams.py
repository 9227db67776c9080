"""Streaming cases: the given tables are read as file streams and drained."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.operators import dedup as dd
from tracelake.operators.consent import policy_tables
from tracelake.session import many_folders, materialize, shared_dir, write_folders
from tracelake.sources import ledger
from tracelake.streaming import activity, memory, sync
from tracelake.suite.registry import BASE_SECOND, case, rule_steps, table
from tracelake.suite.sources import event_lines


def stream(spark, sf, name):
    # a pattern, so that the source takes one file as well as a folder of files
    return spark.readStream.schema(table(spark, sf, name).schema).parquet(f"{sf}/{name}.parque[t]")


def drained(spark, df, label):
    return sync.run_to_end(df, shared_dir(spark, label), shared_dir(spark, f"{label}-cp"))


@case("stream_redact", f"WITH {rule_steps('documents', 'text', keep='doc_id')} SELECT doc_id, txt AS text FROM r")
def stream_redact(spark, sf):
    cores = spark.sparkContext.defaultParallelism
    few = table(spark, sf, "documents").rdd.getNumPartitions() < cores
    rows = stream(spark, sf, "documents").select("doc_id", "text")
    return drained(spark, sync.stream_redact(rows, ["text"], pieces=cores if few else None), "redact")


PRINT_SQL = "SELECT DISTINCT 'a' || (doc_id % 3) AS agent_id, sha256(text) AS fingerprint FROM documents"


def doc_prints(df):
    return df.select(F.concat(F.lit("a"), (F.col("doc_id") % 3).cast("string")).alias("agent_id"),
                     F.sha2("text", 256).alias("fingerprint"), F.concat(F.lit("s"), F.col("doc_id").cast("string")).alias("session_id"),
                     F.col("doc_id").alias("arrival"), F.timestamp_seconds(F.col("doc_id") + BASE_SECOND).alias("ts"))


@case("stream_dedup", PRINT_SQL)
def stream_dedup(spark, sf):
    out = sync.stream_dedup(doc_prints(stream(spark, sf, "documents")), "ts", "365 days")
    return drained(spark, out.select("agent_id", "fingerprint"), "dedup")


@case("stream_dedup_exact", """SELECT 'a' || (doc_id % 3) AS agent_id, sha256(text) AS fingerprint, 's' || min(doc_id) AS session_id FROM documents GROUP BY 1, 2""")
def stream_dedup_exact(spark, sf):
    out = shared_dir(spark, "ledger")
    sync.run_batches(doc_prints(stream(spark, sf, "documents")), sync.ledger_dedup(out), shared_dir(spark, "ledger-cp"))
    return spark.read.parquet(f"{out}/fingerprints").select("agent_id", "fingerprint", "session_id")


@case("state_ttl", "SELECT DISTINCT 'src' || (user_id % 3) AS source, 'u' || user_id || '-' || event_type AS session_id FROM events")
def state_ttl(spark, sf):
    e = stream(spark, sf, "events").select(
        F.concat(F.lit("src"), (F.col("user_id") % 3).cast("string")).alias("source"),
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"), "event_type").alias("session_id"),
        F.col("ts").cast("timestamp").alias("ts"))
    return drained(spark, sync.stream_seen_ids(e, "ts", "60 days").select("source", "session_id"), "ttl")


STATUS = "CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'uploaded' ELSE 'skipped' END"
CLOSED = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


def stream_outcomes(spark, sf):
    return stream(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("src"), (F.col("user_id") % 3).cast("string")).alias("source"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("session_id"), F.expr(STATUS).alias("status"))


@case("stream_tick_windows", f"""SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS tick_start, 'src' || (user_id % 3) AS source,
 count(*) FILTER ({STATUS} = 'uploaded') AS uploaded, count(*) FILTER ({STATUS} = 'skipped') AS skipped, count(*) FILTER ({STATUS} = 'failed') AS failed
 FROM events WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= {CLOSED} GROUP BY 1, 2""")
def stream_tick_windows(spark, sf):
    out = drained(spark, sync.tick_windows(stream_outcomes(spark, sf), "ts", "1 hour"), "ticks")
    return out.withColumn("tick_start", F.date_format("tick_start", "yyyy-MM-dd HH:mm:ss"))


@case("stream_tick_metrics", f"""SELECT coalesce(source, '*total*') AS source, count(*) FILTER (s = 'uploaded') AS uploaded, count(*) FILTER (s = 'skipped') AS skipped,
 CAST(0 AS BIGINT) AS skipped_consent, count(*) FILTER (s = 'failed') AS failed, count(*) AS available_now
 FROM (SELECT 'src' || (user_id % 3) AS source, {STATUS} AS s FROM events) GROUP BY ROLLUP (source)""")
def stream_tick_metrics(spark, sf):
    out = shared_dir(spark, "metrics")
    sync.run_batches(stream_outcomes(spark, sf), sync.tick_metrics_sink(out), shared_dir(spark, "metrics-cp"))
    per = spark.read.parquet(out)
    nums = ["uploaded", "skipped", "skipped_consent", "failed", "available_now"]
    return per.groupBy("source").agg(*[F.sum(c).alias(c) for c in nums])


@case("deep_backfill_stream", """SELECT 'x' || o_orderkey AS experience_id, 'done' AS sanitization_status, 'name:' || (o_orderkey % 5) AS strict_redactions
 FROM orders WHERE o_orderkey % 6 > 2 AND o_orderstatus = 'O'""")
def deep_backfill_stream(spark, sf):
    def rows(df):
        return df.select(F.concat(F.lit("x"), F.col("o_orderkey").cast("string")).alias("experience_id"), "o_orderkey", "o_orderstatus",
                         F.when(F.col("o_orderkey") % 6 > 2, "layer1_only").otherwise("done").alias("sanitization_status"),
                         F.lit(None).cast("string").alias("strict_redactions"))
    res = rows(table(spark, sf, "orders")).filter("o_orderstatus = 'O'").select("experience_id", F.concat(
        F.lit("name:"), (F.col("o_orderkey") % 5).cast("string")).alias("strict_redactions"))
    return drained(spark, sync.deep_drain(rows(stream(spark, sf, "orders")), res).drop("o_orderkey", "o_orderstatus"), "deep")


@case("stream_sync", """WITH n AS (SELECT conv_id, count(*) FILTER (role IN ('user', 'assistant')) AS base,
  count(*) FILTER (role = 'assistant' AND turn % 4 = 1) AS thinking, count(*) FILTER (role = 'user' AND conv_id % 3 = 1 AND turn > 0) AS results FROM conversations GROUP BY conv_id)
 SELECT 's' || conv_id AS session_id, CASE WHEN conv_id % 5 = 3 THEN 'skipped_consent' ELSE 'uploaded' END AS status,
  CASE WHEN conv_id % 5 <> 3 THEN base + thinking + results END AS n_turns FROM n""")
def stream_sync(spark, sf):
    """Session files are written and ingested by the stream in several batches; one folder is closed to it."""
    src, out = shared_dir(spark, "inbox"), shared_dir(spark, "gold")
    rows = event_lines(spark, sf).withColumn("p", F.pmod(F.xxhash64("session_id"), F.lit(4)))
    write_folders(rows.withColumn("value", F.col("raw")), src, "p", "session_id", order=("block", "seq"))

    # the writer names files itself, so here the folder is the session
    policy = policy_tables(spark, {"cwd_rules": [{"glob": "/w/3", "mode": "never"}], "mode": "always"})
    files = max(1, table(spark, sf, "conversations").select("conv_id").distinct().count() // 3)
    with many_folders(spark):
        sync.stream_sync(spark, src, out, shared_dir(spark, "sync-cp"), "a1", max_files=files, glob="*.txt", policy=policy,
                         session=lambda path: F.regexp_extract(path, "session_id=([^/]+)/", 1)).awaitTermination()
    kept = spark.read.parquet(f"{out}/turns").groupBy(F.substring_index("session_id", "/", -1).alias("session_id")).agg(F.count(F.lit(1)).alias("n_turns"))
    return spark.read.parquet(f"{out}/outcomes").select("session_id", "status").join(kept, "session_id", "left")



KIND = "CASE event_type WHEN 'error' THEN 'override' WHEN 'click' THEN 'pending' WHEN 'purchase' THEN 'uploaded' ELSE 'ask' END"
MODE = "CASE event_id % 3 WHEN 0 THEN 'always' WHEN 1 THEN 'never' ELSE 'ask' END"


def arrivals(spark, sf, parts=3):
    """Events as files that arrive one after the other: cut by time, but for the seconds around a cut."""
    e = table(spark, sf, "events")
    lo, hi = e.agg(F.min("ts"), F.max("ts")).first()
    at = F.unix_micros(F.col("ts").cast("timestamp")) + F.pmod(F.xxhash64("event_id"), F.lit(600 * memory.SECOND)) - F.lit(300 * memory.SECOND)
    first = F.unix_micros(F.lit(lo).cast("timestamp"))
    part = F.floor((at - first) * parts / F.greatest(F.lit(1), F.unix_micros(F.lit(hi).cast("timestamp")) - first))
    rows = e.withColumn("part", F.least(F.greatest(part, F.lit(0)), F.lit(parts - 1)))
    inbox = shared_dir(spark, "events")
    for i in range(parts):
        rows.filter(F.col("part") == i).drop("part").write.mode("append").parquet(inbox)
    return spark.readStream.schema(e.schema).option("maxFilesPerTrigger", spark.sparkContext.defaultParallelism).parquet(inbox)


@case("session_memory", f"""WITH e AS (SELECT 'src' || (user_id % 3) AS source, 'u' || user_id || '-' || (event_id % 4) AS session_id, event_id, ts AS t, {KIND} AS kind, {MODE} AS mode FROM events),
 w AS (SELECT date_trunc('millisecond', max(t)) - INTERVAL 1 HOUR AS passed FROM e),
 known AS (SELECT *, last_value(CASE WHEN kind = 'override' THEN mode END IGNORE NULLS) OVER past AS last_mode, last_value(CASE WHEN kind = 'override' THEN t END IGNORE NULLS) OVER past AS last_at
  FROM e WINDOW past AS (PARTITION BY source, session_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 o AS (SELECT *, lead(t) OVER (PARTITION BY source, session_id ORDER BY t, event_id) AS next_at FROM e WHERE kind = 'override'),
 p AS (SELECT *, lead(t) OVER s AS next_at, lag(kind) OVER s AS last_kind, lag(t) OVER s AS last_at FROM e WHERE kind IN ('pending', 'uploaded') WINDOW s AS (PARTITION BY source, session_id ORDER BY t, event_id)),
 r AS (SELECT source, session_id, t, event_id, 'answered' AS what, CASE WHEN t < last_at + INTERVAL 1 DAY THEN last_mode END AS mode FROM known WHERE kind = 'ask'
  UNION ALL SELECT source, session_id, t + INTERVAL 1 DAY, NULL, 'override_expired', mode FROM o WHERE next_at IS NULL OR next_at >= t + INTERVAL 1 DAY
  UNION ALL SELECT source, session_id, t + INTERVAL 7 DAY, NULL, 'pending_expired', NULL FROM p WHERE kind = 'pending' AND (next_at IS NULL OR next_at > t + INTERVAL 7 DAY)
  UNION ALL SELECT source, session_id, t, event_id, 'pending_taken', NULL FROM p WHERE kind = 'uploaded' AND last_kind = 'pending' AND t <= last_at + INTERVAL 7 DAY)
 SELECT source, session_id, strftime(t, '%Y-%m-%d %H:%M:%S.%f') AS happened_at, event_id, what, mode FROM r, w WHERE t < passed""")
def session_memory(spark, sf):
    """Overrides of a day and pending sessions of a week, answered in the order of time."""
    e = arrivals(spark, sf).select(
        F.concat(F.lit("src"), (F.col("user_id") % 3).cast("string")).alias("source"), "event_id", F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"), (F.col("event_id") % 4).cast("string")).alias("session_id"),
        F.expr(KIND).alias("kind"), F.expr(MODE).alias("mode"))
    with memory.state_store(spark):
        out = drained(spark, memory.session_memory(e, "ts", "1 hour"), "memory")
    return out.select("source", "session_id", F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("happened_at"), "event_id", "what", "mode")


@case("newest_ids", """SELECT source, session_id, strftime(seen, '%Y-%m-%d %H:%M:%S.%f') AS seen_at FROM (
  SELECT 'src' || (user_id % 3) AS source, 'u' || user_id || '-' || (event_id % 997) AS session_id, max(ts) AS seen FROM events GROUP BY 1, 2)
 QUALIFY row_number() OVER (PARTITION BY source ORDER BY seen DESC, session_id DESC) <= 500""")
def newest_ids(spark, sf):
    """The newest ids of each source, of which there may be any number, read from the stream's state."""
    e = arrivals(spark, sf).select(
        F.concat(F.lit("src"), (F.col("user_id") % 3).cast("string")).alias("source"), F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"), (F.col("event_id") % 997).cast("string")).alias("session_id"))
    checkpoint = shared_dir(spark, "newest-cp")
    with memory.state_store(spark):
        memory.newest_ids(e, "ts", keep=500).writeStream.outputMode("update").foreachBatch(lambda batch, _: batch.count()).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return memory.kept_ids(spark, checkpoint, keep=500).withColumn("seen_at", F.date_format("seen_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@case("dedup_ledger_index", """WITH d AS (SELECT doc_id, 'a' || (doc_id % 3) AS agent_id, sha256(text) AS fingerprint, doc_id % 4 AS part FROM documents),
 new AS (SELECT agent_id, fingerprint, 's' || min(doc_id) AS session_id FROM d WHERE part = 3 GROUP BY ALL)
 SELECT n.*, NULL AS experience_id FROM new n WHERE NOT EXISTS (SELECT 1 FROM d WHERE part < 3 AND d.agent_id = n.agent_id AND d.fingerprint = n.fingerprint)
 UNION ALL SELECT d.agent_id, d.fingerprint, 's' || d.doc_id, min('x' || h.doc_id) FROM d JOIN d h ON h.part < 3 AND h.agent_id = d.agent_id AND h.fingerprint = d.fingerprint
  WHERE d.part = 3 GROUP BY d.agent_id, d.fingerprint, d.doc_id""")
def dedup_ledger_index(spark, sf):
    """Three quarters of the documents as a history of three batches, two of them merged; the rest looks into its index."""
    out = shared_dir(spark, "history")
    rows = doc_prints(table(spark, sf, "documents")).withColumn("part", F.col("arrival") % 4)
    for b in range(3):
        ledger.write_ledger(rows.filter(F.col("part") == b).select("agent_id", "fingerprint", "session_id", F.concat(
            F.lit("x"), F.col("arrival").cast("string")).alias("experience_id")), out, f"b{b}")
    ledger.compact(spark, out, ["b0", "b1"])
    batch = materialize(rows.filter(F.col("part") == 3).drop("part"), "batch")
    new, known = dd.dedup_ledger_antijoin(batch, ledger.lookup(spark, out, "b3", batch))
    return new.select("agent_id", "fingerprint", "session_id", F.lit(None).cast("string").alias("experience_id")).unionByName(known)


@case("activity_windows", """WITH e AS (SELECT 'src' || (user_id % 3) AS source, user_id, ts, CAST(event_type = 'error' AS BIGINT) AS bad FROM events),
 s AS (SELECT *, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS starts FROM e WINDOW w AS (PARTITION BY source, user_id ORDER BY ts)),
 g AS (SELECT *, sum(starts) OVER (PARTITION BY source, user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS burst FROM s)
 SELECT source, user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS started, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS ended, count(*) AS n_events, CAST(sum(bad) AS BIGINT) AS n_errors
 FROM g GROUP BY source, user_id, burst HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM e)""")
def activity_windows(spark, sf):
    e = arrivals(spark, sf).select(F.concat(F.lit("src"), (F.col("user_id") % 3).cast("string")).alias("source"), "user_id", "event_type",
                                   F.col("ts").cast("timestamp").alias("ts"))
    out = drained(spark, activity.activity_windows(e, ["source", "user_id"], "ts", "6 hours", "1 hour", {"n_errors": "count_if(event_type = 'error')"}), "bursts")
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("started", "ended")})


@case("deep_queue", """WITH q AS (SELECT event_id, 'x' || event_id AS experience_id, ts AS queued_at FROM events WHERE event_type <> 'view'),
 v AS (SELECT experience_id, CASE event_id % 5 WHEN 0 THEN ts - INTERVAL 6 HOUR WHEN 1 THEN ts + INTERVAL 2 DAY WHEN 2 THEN ts + INTERVAL 8 DAY ELSE ts + INTERVAL 1 HOUR END AS verdict_at,
   'name:' || (event_id % 4) AS strict_redactions FROM (SELECT event_id, ts, 'x' || event_id AS experience_id FROM events) WHERE event_id % 5 <> 4),
 w AS (SELECT least((SELECT max(queued_at) FROM q), (SELECT max(verdict_at) FROM v)) - INTERVAL 1 DAY AS passed)
 SELECT q.experience_id, CASE WHEN v.experience_id IS NULL THEN 'expired' ELSE 'done' END AS sanitization_status, v.strict_redactions
 FROM q CROSS JOIN w LEFT JOIN v ON v.experience_id = q.experience_id AND v.verdict_at >= q.queued_at - INTERVAL 1 DAY AND v.verdict_at <= q.queued_at + INTERVAL 7 DAY
 WHERE v.experience_id IS NOT NULL OR q.queued_at + INTERVAL 7 DAY < passed""")
def deep_queue(spark, sf):
    """Rows that wait and verdicts on them, each a stream; some verdicts come before their row, some too late, some never."""
    e = stream(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    name = F.concat(F.lit("x"), F.col("event_id").cast("string")).alias("experience_id")
    queue = e.filter("event_type <> 'view'").select(name, F.col("ts").alias("queued_at"))
    late = F.expr("CASE event_id % 5 WHEN 0 THEN ts - INTERVAL 6 HOUR WHEN 1 THEN ts + INTERVAL 2 DAY WHEN 2 THEN ts + INTERVAL 8 DAY ELSE ts + INTERVAL 1 HOUR END")
    verdicts = e.filter("event_id % 5 <> 4").select(name, late.alias("verdict_at"), F.concat(F.lit("name:"), (F.col("event_id") % 4).cast("string")).alias("strict_redactions"))
    return drained(spark, activity.deep_queue(queue, verdicts), "queue").select("experience_id", "sanitization_status", "strict_redactions")


@case("stream_observed_metrics", f"""SELECT coalesce(source, '*total*') AS source, count(*) FILTER (s = 'uploaded') AS uploaded, count(*) FILTER (s = 'skipped') AS skipped,
 CAST(0 AS BIGINT) AS skipped_consent, count(*) FILTER (s = 'failed') AS failed, count(*) AS available_now
 FROM (SELECT 'src' || (user_id % 3) AS source, {STATUS} AS s FROM events) GROUP BY ROLLUP (source)""")
def stream_observed_metrics(spark, sf):
    """Outcomes are stored once; what was counted on the way equals the summary."""
    out = shared_dir(spark, "outcomes")
    metrics = activity.run_observed(stream_outcomes(spark, sf), ["src0", "src1", "src2"], out, shared_dir(spark, "outcomes-cp")).table(spark)
    nums = ["uploaded", "skipped", "skipped_consent", "failed", "available_now"]
    return metrics.groupBy("source").agg(*[F.sum(c).alias(c) for c in nums])
