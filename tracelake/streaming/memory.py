"""Keyed state with an end: session overrides, pending sessions, and the newest handled ids.

What a session is allowed is remembered per session and ends by itself: an override after a
day, a pending session after a week. Ends are moments of event time, kept as timers, so a
replay gives the same rows. Events wait until the watermark has passed them and are then taken
in the order of their time, however they arrived; those later than the watermark are dropped.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SECOND = 1_000_000
OVERRIDE_TTL, PENDING_TTL = 24 * 3600, 7 * 24 * 3600
KEEP = 5000
PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Event(NamedTuple):
    at: int          # microseconds
    event_id: int
    kind: str        # 'override' | 'ask' | 'pending' | 'uploaded'
    mode: str | None


class Memory(NamedTuple):
    mode: str | None = None
    mode_end: int | None = None       # the override holds before this moment
    pending_end: int | None = None    # the pending session is kept up to this moment

    def next_end(self) -> int | None:
        return min((t for t in (self.mode_end, self.pending_end) if t is not None), default=None)


def advance(memory: Memory, events: Iterable[Event], until: int, override_ttl: int = OVERRIDE_TTL,
            pending_ttl: int = PENDING_TTL) -> tuple[list[tuple], Memory, list[Event]]:
    """What happens before ``until``: rows ``(at, event_id, what, mode)``, the memory then, and the events left."""
    mode, mode_end, pending_end = memory
    out: list[tuple] = []

    def lapse(now: int, reached: bool) -> None:
        """Ends up to ``now``; an override is over at its end, a pending session only after it."""
        nonlocal mode, mode_end, pending_end
        ends = []
        if mode_end is not None and (mode_end < now or (reached and mode_end == now)):
            ends.append((mode_end, None, "override_expired", mode))
            mode = mode_end = None
        if pending_end is not None and pending_end < now:
            ends.append((pending_end, None, "pending_expired", None))
            pending_end = None
        out.extend(sorted(ends, key=lambda e: (e[0], e[2])))

    left = []
    for e in sorted(events):
        if e.at >= until:
            left.append(e)
            continue
        lapse(e.at, reached=True)
        if e.kind == "override":
            mode, mode_end = e.mode, e.at + override_ttl * SECOND
        elif e.kind == "ask":
            out.append((e.at, e.event_id, "answered", mode))
        elif e.kind == "pending":
            pending_end = e.at + pending_ttl * SECOND
        elif e.kind == "uploaded" and pending_end is not None:
            out.append((e.at, e.event_id, "pending_taken", None))
            pending_end = None
    lapse(until, reached=False)
    return out, Memory(mode, mode_end, pending_end), left


class SessionMemory(StatefulProcessor):
    """State per (source, session): what is remembered, the events that wait, and a timer for what comes first. A
    checkpoint of the former two state variables cannot be continued."""

    def __init__(self, override_ttl: int = OVERRIDE_TTL, pending_ttl: int = PENDING_TTL):
        self.override_ttl, self.pending_ttl = override_ttl, pending_ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # one variable with the waiting events as JSON: every call to the store is a round trip between two processes
        self.memory = handle.getValueState("memory", "mode string, mode_end long, pending_end long, timer long, waiting string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        return self._step(key, [Event(at_us, event_id, kind, mode) for _, _, event_id, kind, mode, at_us, _ in rows], timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return self._step(key, [], timerValues, fired=expiredTimerInfo.getExpiryTimeInMs())

    def _step(self, key, new: list[Event], timers, fired: int | None = None) -> Iterator[Row]:
        kept = self.memory.get()
        memory = Memory(*kept[:3]) if kept else Memory()
        timer = None if kept is None or kept[3] == fired else kept[3]
        waiting = [Event(*w) for w in json.loads(kept[4])] if kept and kept[4] else []
        until = max(0, timers.getCurrentWatermarkInMs()) * 1000
        new = [e for e in new if e.at >= until]  # what is earlier has been passed already
        out, memory, left = advance(memory, waiting + new, until, self.override_ttl, self.pending_ttl)
        first = min([e.at for e in left[:1]] + [t for t in (memory.next_end(),) if t is not None], default=None)
        if first is None:
            if kept:
                self.memory.clear()  # nothing to remember: the key takes no room
        else:
            due = first // 1000 + 1
            if timer is None or due < timer:
                self.handle.registerTimer(due)
                timer = due
            now = (*memory, timer, json.dumps(left) if left else None)
            if kept is None or now != tuple(kept):
                self.memory.update(now)
        for at, event_id, what, mode in out:
            yield Row(source=key[0], session_id=key[1], at_us=at, event_id=event_id, what=what, mode=mode)

    def close(self) -> None:
        pass


def session_memory(events: DataFrame, time_col: str = "ts", delay: str = "10 minutes", override_ttl: int = OVERRIDE_TTL,
                   pending_ttl: int = PENDING_TTL) -> DataFrame:
    """Answers to the events of a stream ``source, session_id, event_id, kind, mode, <time_col>``.

    ``what`` is 'answered' (the mode of the override that holds, or null), 'override_expired',
    'pending_expired' or 'pending_taken', at event time ``at``. Sessions are spread over all
    tasks. The stream must run under ``state_store``.
    """
    rows = events.withWatermark(time_col, delay).select(
        "source", "session_id", "event_id", "kind", "mode", F.unix_micros(time_col).alias("at_us"), F.col(time_col))
    out = rows.groupBy("source", "session_id").transformWithState(
        SessionMemory(override_ttl, pending_ttl), "source string, session_id string, at_us long, event_id long, what string, mode string",
        "Append", "EventTime")
    return out.select("source", "session_id", F.timestamp_micros("at_us").alias("at"), "event_id", "what", "mode")


class NewestIds(StatefulProcessor):
    """Per key the newest ``keep`` ids by the time they were last seen; of equal times the larger id."""

    def __init__(self, keep: int = KEEP):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ids = handle.getListState("ids", "seen_us long, session_id string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen: dict[str, int] = {w[1]: w[0] for w in self.ids.get()} if self.ids.exists() else {}
        for r in rows:
            if r.seen_us > seen.get(r.session_id, -1 << 63):
                seen[r.session_id] = r.seen_us
            if len(seen) > 4 * self.keep:
                seen = self._newest(seen)
        seen = self._newest(seen)
        self.ids.put(sorted((t, s) for s, t in seen.items()))
        yield Row(source=key[0], part=key[1], n_ids=len(seen), oldest_us=min(seen.values()))

    def _newest(self, seen: dict[str, int]) -> dict[str, int]:
        if len(seen) <= self.keep:
            return seen
        return {s: t for t, s in heapq.nlargest(self.keep, ((t, s) for s, t in seen.items()))}

    def close(self) -> None:
        pass


def newest_ids(handled: DataFrame, time_col: str = "ts", keep: int = KEEP, parts: int = 16) -> DataFrame:
    """Bounded memory of handled ids ``source, session_id, <time_col>``; rows tell how many a part holds.

    A source is dealt over ``parts`` keys by id, each with its own newest ``keep``, so that one
    source is never one task; ``kept_ids`` takes the newest ``keep`` of a source from them.
    """
    part = F.pmod(F.xxhash64("session_id"), F.lit(parts)).cast("int")
    rows = handled.select("source", part.alias("part"), "session_id", F.unix_micros(time_col).alias("seen_us"))
    return rows.groupBy("source", "part").transformWithState(
        NewestIds(keep), "source string, part int, n_ids int, oldest_us long", "Update", "None")


def kept_ids(spark: SparkSession, checkpoint: str, keep: int = KEEP) -> DataFrame:
    """``source, session_id, seen_at``: what a stream of ``newest_ids`` remembers, read from its state."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "ids").load()
    held = state.select(F.col("key.source").alias("source"), "list_element.*")
    order = Window.partitionBy("source").orderBy(F.desc("seen_us"), F.desc("session_id"))
    held = held.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)
    return held.select("source", "session_id", F.timestamp_micros("seen_us").alias("seen_at"))


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Start queries with keyed processors inside: their state needs a store that holds several variables."""
    before = spark.conf.get(PROVIDER_CONF, None)
    spark.conf.set(PROVIDER_CONF, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER_CONF) if before is None else spark.conf.set(PROVIDER_CONF, before)
