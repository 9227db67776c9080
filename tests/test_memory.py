"""State that ends by itself: order of arrival, restarts, and what is remembered."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tracelake.streaming import memory as sm
from tracelake.streaming.memory import Event, Memory, advance

H = 3600 * sm.SECOND
BASE = 1_704_067_200 * sm.SECOND


def test_override_answers_until_its_end():
    events = [Event(0, 1, "ask", None), Event(H, 2, "override", "always"), Event(2 * H, 3, "ask", None),
              Event(25 * H, 5, "ask", None), Event(24 * H, 4, "ask", None)]
    out, memory, left = advance(Memory(), events, 30 * H)
    assert out == [(0, 1, "answered", None), (2 * H, 3, "answered", "always"), (24 * H, 4, "answered", "always"),
                   (25 * H, None, "override_expired", "always"), (25 * H, 5, "answered", None)]
    assert memory == Memory() and left == []


def test_pending_is_kept_through_its_last_moment():
    week = 7 * 24 * H
    taken, _, _ = advance(Memory(), [Event(0, 1, "pending", None), Event(week, 2, "uploaded", None)], week + H)
    assert taken == [(week, 2, "pending_taken", None)]
    gone, _, _ = advance(Memory(), [Event(0, 1, "pending", None), Event(week + 1, 2, "uploaded", None)], week + H)
    assert gone == [(week, None, "pending_expired", None)]
    renewed, memory, _ = advance(Memory(), [Event(0, 1, "pending", None), Event(H, 2, "pending", None)], week + H)
    assert renewed == [] and memory.pending_end == week + H


def test_any_cut_of_time_gives_the_same_rows():
    rng = random.Random(1)
    events = [Event(rng.randrange(400) * H // 4, i, rng.choice(["override", "ask", "ask", "pending", "uploaded"]), rng.choice(["always", "never"])) for i in range(300)]
    whole, end, _ = advance(Memory(), events, 2000 * H)
    for _ in range(20):
        cuts = sorted(rng.sample(range(0, 200), 6)) + [2000]
        rows, memory, waiting, arrived = [], Memory(), [], 0
        for cut in cuts:  # everything below the cut has arrived, and some more, in any order
            new = [e for e in events if arrived <= e.at < (cut + 5) * H]
            arrived = (cut + 5) * H
            rng.shuffle(new)
            out, memory, waiting = advance(memory, waiting + new, cut * H)
            rows += out
        assert rows == whole and memory == end


SCHEMA = "source string, session_id string, event_id long, kind string, mode string, ts timestamp"


def write(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, build, inbox, out, checkpoint, mode="append"):
    with sm.state_store(spark):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(inbox)
        writer = build(stream).writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        if mode == "append":
            writer.format("parquet").option("path", out).start().awaitTermination()
        else:
            writer.foreachBatch(lambda batch, _: batch.write.mode("append").parquet(out)).start().awaitTermination()


def made(n=240, sessions=9):
    rng = random.Random(8)
    return [(f"src{i % 2}", f"s{rng.randrange(sessions)}", i, rng.choice(["override", "ask", "ask", "pending", "uploaded"]), rng.choice(["always", "never"]),
             dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=137 * i, microseconds=i)) for i in range(n)]


def wanted(rows, delay_us):
    until = (max(int(r[5].timestamp() * 1_000_000) for r in rows) - delay_us) // 1000 * 1000
    out = set()
    for key in {r[:2] for r in rows}:
        events = [Event(round(r[5].timestamp() * 1_000_000), r[2], r[3], r[4]) for r in rows if r[:2] == key]
        out |= {(*key, *x) for x in advance(Memory(), events, until)[0]}
    return out


def test_stream_survives_restart_and_disorder(spark, tmp_path):
    rows = made()
    inbox, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    chunks = [rows[i:i + 60] for i in range(0, 240, 60)]
    for a, b in ((0, 1), (2, 3)):  # neighbours swap some events, less than the delay apart
        chunks[a][-3:], chunks[b][:3] = chunks[b][:3], chunks[a][-3:]
    for chunk in chunks[:2]:
        write(spark, chunk, inbox)
    build = lambda s: sm.session_memory(s, "ts", "1 day")
    run(spark, build, inbox, out, check)
    first = spark.read.parquet(out).count()
    for chunk in chunks[2:]:
        write(spark, chunk, inbox)
    run(spark, build, inbox, out, check)
    got = [(r["source"], r["session_id"], r["at_us"], r["event_id"], r["what"], r["mode"])
           for r in spark.read.parquet(out).withColumn("at_us", F.unix_micros("at")).collect()]
    assert len(got) == len(set(got)) > first > 0
    assert set(got) == wanted(rows, 24 * H)
    assert {r[4] for r in got} == {"answered", "override_expired", "pending_expired", "pending_taken"}


def test_late_events_are_dropped(spark, tmp_path):
    inbox, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    at = lambda h: dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(hours=h)
    write(spark, [("a", "s", 1, "override", "always", at(0)), ("a", "t", 2, "ask", None, at(50))], inbox)
    write(spark, [("a", "s", 3, "ask", None, at(1)), ("a", "t", 4, "ask", None, at(60)), ("a", "s", 6, "ask", None, at(58))], inbox)
    write(spark, [("a", "u", 5, "ask", None, at(90))], inbox)
    run(spark, lambda s: sm.session_memory(s, "ts", "1 hour"), inbox, out, check)
    got = {(r["event_id"], r["what"], r["mode"]) for r in spark.read.parquet(out).collect()}
    assert got == {(None, "override_expired", "always"), (2, "answered", None), (4, "answered", None), (6, "answered", None)}


@pytest.mark.parametrize("keep", [1, 5, 1000])
def test_newest_ids_over_restarts(spark, tmp_path, keep):
    rows = made(120, 30)
    random.Random(2).shuffle(rows)
    inbox, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    for half in (rows[:60], rows[60:]):
        write(spark, half, inbox)
        run(spark, lambda s: sm.newest_ids(s, "ts", keep, 4), inbox, out, check, "update")
    last = {}
    for s, i, *_, ts in rows:
        last[s, i] = max(ts, last.get((s, i), ts))
    want = set()
    for s in ("src0", "src1"):
        want |= {(s, i, t) for t, i in sorted(((t, i) for (x, i), t in last.items() if x == s), reverse=True)[:keep]}
    got = {(r["source"], r["session_id"], r["seen_at"].replace(tzinfo=dt.timezone.utc)) for r in sm.kept_ids(spark, check, keep).collect()}
    assert got == want
    assert spark.read.parquet(out).agg(F.max("n_ids")).first()[0] <= keep
