"""Merged session windows, a queue against late verdicts, and observed metrics, in several batches out of order."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tracelake.operators import governance as gv
from tracelake.streaming import activity as ac

DAY0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(hours):
    return DAY0 + dt.timedelta(hours=hours)


def arrive(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def drain(spark, stream, out, checkpoint):
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def source(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def bursts(rows, gap, passed):
    out, keys = [], {k for k, _ in rows}
    for key in keys:
        times = sorted(t for k, t in rows if k == key)
        run = [times[0]]
        for t in times[1:] + [None]:
            if t is not None and t - run[-1] <= gap:
                run.append(t)
                continue
            if run[-1] + gap <= passed:
                out.append((key, run[0], run[-1], len(run)))
            run = [t]
    return sorted(out)


def test_a_late_event_joins_two_bursts(spark, tmp_path):
    schema = "k string, ts timestamp"
    inbox = str(tmp_path / "in")
    rows = [("a", at(0)), ("a", at(1)), ("a", at(3.4)), ("b", at(2)), ("a", at(1.9)), ("a", at(2.6)), ("b", at(9)), ("c", at(30))]
    for part in (rows[:4], rows[4:6], rows[6:]):
        arrive(spark, part, schema, inbox)
    got = drain(spark, ac.activity_windows(source(spark, schema, inbox), ["k"], "ts", "1 hour", "4 hours"), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = sorted((r["k"], r["started"].replace(tzinfo=dt.timezone.utc), r["ended"].replace(tzinfo=dt.timezone.utc), r["n_events"]) for r in got.collect())
    assert got == [("a", at(0), at(3.4), 5), ("b", at(2), at(2), 1), ("b", at(9), at(9), 1)]
    assert got == bursts(rows, dt.timedelta(hours=1), at(26))


def test_bursts_over_a_restart_equal_one_pass(spark, tmp_path):
    schema, rng = "k string, ts timestamp", random.Random(4)
    rows = [(rng.choice("abc"), at(i * 0.3 + rng.random())) for i in range(300)]
    inbox, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    for half in (rows[:150], rows[150:]):
        for lo in range(0, 150, 50):
            arrive(spark, half[lo:lo + 50], schema, inbox)
        got = drain(spark, ac.activity_windows(source(spark, schema, inbox), ["k"], "ts", "40 minutes", "3 hours"), out, cp)
    got = sorted((r["k"], r["started"].replace(tzinfo=dt.timezone.utc), r["ended"].replace(tzinfo=dt.timezone.utc), r["n_events"]) for r in got.collect())
    assert got == bursts(rows, dt.timedelta(minutes=40), max(t for _, t in rows) - dt.timedelta(hours=3))


def test_queue_meets_verdicts_in_any_order(spark, tmp_path):
    waits, tells = "experience_id string, queued_at timestamp", "experience_id string, verdict_at timestamp, strict_redactions string"
    q, v = str(tmp_path / "q"), str(tmp_path / "v")
    queued = [[("x1", at(0)), ("x2", at(1)), ("x3", at(2))], [("x4", at(30)), ("x5", at(31))], [("end", at(400))]]
    told = [[("x4", at(20), "early"), ("x1", at(5), "a"), ("x1", at(5), "a again")], [("x2", at(200), "too late"), ("x9", at(40), "nobody")], [("x5", at(90), "b"), ("end2", at(400), "")]]
    for rows in queued:
        arrive(spark, rows, waits, q)
    for rows in told:
        arrive(spark, rows, tells, v)
    stream = ac.deep_queue(source(spark, waits, q), source(spark, tells, v), within="7 days", early="1 day", delay="10 days")
    got = {r["experience_id"]: (r["sanitization_status"], r["strict_redactions"]) for r in drain(spark, stream, str(tmp_path / "out"), str(tmp_path / "cp")).collect()}
    assert got.pop("x1")[0] == "done"
    assert got == {"x4": ("done", "early"), "x5": ("done", "b")}  # nothing has expired yet: the watermark is ten days behind
    arrive(spark, [("end3", at(1000))], waits, q)
    arrive(spark, [("end4", at(1000), "")], tells, v)
    rows = drain(spark, stream, str(tmp_path / "out"), str(tmp_path / "cp")).collect()
    got = {r["experience_id"]: (r["sanitization_status"], r["strict_redactions"]) for r in rows}
    assert len(got) == len(rows)
    assert {k: got[k] for k in ("x2", "x3", "end")} == {"x2": ("expired", None), "x3": ("expired", None), "end": ("expired", None)}


def test_observed_metrics_equal_the_summary_of_each_batch(spark, tmp_path):
    schema, rng = "source string, session_id string, status string", random.Random(6)
    states = ["uploaded", "skipped_seen", "skipped_consent", "failed", "skipped"]
    parts = [[(rng.choice(["a", "b", "c"]), f"s{i}", rng.choice(states)) for i in range(n)] for n in (30, 1, 20)]
    for rows in parts:
        arrive(spark, rows, schema, str(tmp_path / "in"))
    metrics = ac.run_observed(source(spark, schema, str(tmp_path / "in")), ["a", "b", "unused"], str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 51
    cols = ["source", "uploaded", "skipped", "skipped_consent", "failed", "available_now"]
    for batch, rows in enumerate(parts):
        want = {tuple(r[c] for c in cols) for r in gv.sync_summary(spark.createDataFrame(rows, schema)).collect() if r["source"] != "c"}
        got = {tuple(r[c] for c in cols) for r in metrics.table(spark).filter(F.col("batch_id") == batch).collect()}
        assert got == want
