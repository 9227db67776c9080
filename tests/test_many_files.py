"""Files by the thousand: written by the tasks, listed by a few tasks; keyed state in one variable."""

from pyspark.sql import functions as F

from tracelake import session as se
from tracelake.sources import base, listing
from tracelake.streaming.memory import SessionMemory


def test_one_file_per_key_in_order(spark, tmp_path):
    rows = [(k, i, f"{k}:{i}") for i in range(50) for k in ("a", "b c", None)] + [("a", 50, None)]
    path = str(tmp_path / "in")
    se.write_folders(spark.createDataFrame(rows, "k string, n int, value string").repartition(7), path, "k", order=("n",))
    files = sorted(str(p.relative_to(path)) for p in (tmp_path / "in").rglob("*") if p.is_file())
    assert files == ["k=__HIVE_DEFAULT_PARTITION__/part-0.txt", "k=a/part-0.txt", "k=b c/part-0.txt"]  # no checksums, nothing half done
    assert (tmp_path / "in" / files[1]).read_text() == "".join(f"a:{i}\n" for i in range(50)) + "\n"
    se.write_folders(spark.createDataFrame([], "k string, value string"), str(tmp_path / "none"), "k")
    assert base.read_lines(spark, str(tmp_path / "none")).count() == 0


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    for i in range(200):
        (tmp_path / f"f{i}").mkdir()
        (tmp_path / f"f{i}" / "x.txt").write_text(str(i))
    few = 4 * spark.sparkContext.defaultParallelism
    before = spark.conf.get(se.LISTING_CONF)
    spark.sparkContext.setJobGroup("listing", "folders")
    tracker = spark.sparkContext.statusTracker()

    def tasks(read):
        seen = set(tracker.getJobIdsForGroup(None)) | set(tracker.getJobIdsForGroup("listing"))
        read()
        new = (set(tracker.getJobIdsForGroup(None)) | set(tracker.getJobIdsForGroup("listing"))) - seen
        return [tracker.getStageInfo(s).numTasks for j in new for s in tracker.getJobInfo(j).stageIds]

    for read in (base.read_lines, base.read_docs, listing.raw_manifest):
        told = tasks(lambda: read(spark, str(tmp_path)))
        assert told and max(told) <= few, (read.__name__, told)
        assert read(spark, str(tmp_path)).count() == 200
    assert spark.conf.get(se.LISTING_CONF) == before


class Store:
    def __init__(self):
        self.calls, self.value = 0, None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.calls, self.value = self.calls + 1, None

    def registerTimer(self, due):
        self.calls += 1


class Timers:
    now = 0

    def getCurrentWatermarkInMs(self):
        return self.now


def test_a_step_asks_the_store_three_times():
    step, store, timers = SessionMemory(), Store(), Timers()
    step.handle, step.memory = store, store
    key, hour = ("s", "x"), 3_600_000_000
    rows = [(*key, 1, "override", "never", hour, None), (*key, 2, "ask", None, 2 * hour, None)]
    assert list(step.handleInputRows(key, rows, timers)) == [] and store.calls <= 3
    store.calls, timers.now = 0, 3 * hour // 1000
    assert [(r.event_id, r.mode) for r in step.handleInputRows(key, [], timers)] == [(2, "never")] and store.calls <= 3
    timers.now = 100 * hour // 1000
    assert [r.what for r in step.handleInputRows(key, [], timers)] == ["override_expired"] and store.value is None
