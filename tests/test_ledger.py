"""The stored ledger: what a batch reads, equal results by both ways, and compaction."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tracelake.sources import ledger as lg
from tracelake.streaming import sync

SCHEMA = "agent_id string, fingerprint string, session_id string, experience_id string"


def prints(spark, numbers):
    rows = [("a", hashlib.sha256(str(n).encode()).hexdigest(), f"s{n}", f"x{n}") for n in numbers]
    return spark.createDataFrame(rows, SCHEMA)


def sessions(df):
    return sorted(r["session_id"] for r in df.collect())


def scan_metrics(df):
    """Files and rows that the scan of an executed plan has read."""
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().last()
    return leaf.metrics().apply("numFiles").value(), leaf.metrics().apply("numOutputRows").value()


def test_lookup_is_the_same_by_values_and_by_join(spark, tmp_path):
    out = str(tmp_path)
    assert lg.read_ledger(spark, out) is None
    for b in range(4):
        lg.write_ledger(prints(spark, range(b * 50, b * 50 + 60)), out, f"b{b}")
    asked = prints(spark, [*range(40, 70), *range(1000, 1030)])
    want = sorted([f"s{n}" for n in range(40, 60)])
    assert sessions(lg.lookup(spark, out, "b1", asked)) == sessions(lg.lookup(spark, out, "b1", asked, values=3)) == want
    assert sessions(lg.lookup(spark, out, None, asked)) == sorted([f"s{n}" for n in range(40, 60)] + [f"s{n}" for n in range(50, 70)])
    assert sessions(lg.lookup(spark, out, None, asked.limit(0))) == []


def test_as_many_values_as_are_pushed(spark, tmp_path):
    """The reader's filter of the most values that go along is not so deep that a task's stack overflows."""
    out = str(tmp_path)
    lg.write_ledger(prints(spark, range(3000)), out, "b0")
    asked = prints(spark, range(2500, 2500 + lg.LOOKUPS))
    assert sessions(lg.lookup(spark, out, "now", asked)) == [f"s{n}" for n in range(2500, 3000)]


def test_a_repeated_batch_leaves_one_copy(spark, tmp_path):
    out = str(tmp_path)
    for numbers in (range(40), range(20, 50)):
        lg.write_ledger(prints(spark, numbers), out, "b0")
    assert sessions(lg.read_ledger(spark, out)) == sorted(f"s{n}" for n in range(20, 50))


def test_plan_names_folders_and_pushes_values(spark, tmp_path):
    import contextlib
    import io
    out = str(tmp_path)
    lg.write_ledger(prints(spark, range(300)), out, "b0")
    known = prints(spark, [7]).first()["fingerprint"]
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        lg.read_ledger(spark, out, "now", [f"p{known[:2]}", "p"]).filter(F.col("fingerprint").isin([known, "0"])).explain("formatted")
    lines = dict(line.split(": ", 1) for line in text.getvalue().splitlines() if ": " in line)
    assert "prefix" in lines["PartitionFilters"] and known[:2] in lines["PartitionFilters"]
    assert "In(fingerprint" in lines["PushedFilters"]


def test_cost_of_a_batch_does_not_grow_with_history(spark, tmp_path):
    out, read = str(tmp_path), []
    asked = prints(spark, range(10_000, 10_020))
    values = [r["fingerprint"] for r in asked.collect()]
    folders = sorted({f"p{v[:2]}" for v in values})
    for b in range(3):
        lg.write_ledger(prints(spark, range(b * 2000, b * 2000 + 2000)), out, f"b{b}")
        lg.compact(spark, out, lg._batches(spark, f"{out}/ledger"))
        with lg._values_pushed(spark, 100):
            found = lg.read_ledger(spark, out, "now", folders).filter(F.col("fingerprint").isin(values))
            assert found.collect() == []
            read.append(scan_metrics(found))
    assert lg.read_ledger(spark, out).count() == 6000
    assert {files for files, _ in read} == {len(folders)}  # of 256
    assert all(rows <= 60 for _, rows in read)  # some Bloom filters may say yes


def test_compaction_keeps_every_row(spark, tmp_path):
    out = str(tmp_path)
    prints(spark, range(5)).write.parquet(f"{out}/fingerprints/batch=old")  # a folder without prefixes
    for b in range(3):
        lg.write_ledger(prints(spark, range(100 + b * 10, 110 + b * 10)), out, f"b{b}")
    merged = lg.compact(spark, out, ["old", "b0", "b1"])
    assert {r[0] for r in lg.read_ledger(spark, out).select("batch").distinct().collect()} == {merged, "b2"}
    assert sessions(lg.read_ledger(spark, out)) == sorted(f"s{n}" for n in [*range(5), *range(100, 130)])
    assert sessions(lg.lookup(spark, out, "b9", prints(spark, [3, 105, 125, 999]))) == ["s105", "s125", "s3"]
    assert lg.compact(spark, out, ["old", "b0"]) is not None and lg.read_ledger(spark, out).count() == 35
    assert lg.compact(spark, str(tmp_path / "none"), ["x"]) is None


@pytest.mark.parametrize("values", [0, 2000])
def test_stream_dedup_over_compacted_history(spark, tmp_path, values, monkeypatch):
    monkeypatch.setattr(lg.lookup, "__defaults__", (values,))
    out = str(tmp_path / "out")
    schema = "agent_id string, fingerprint string, session_id string, arrival long"
    for k, numbers in enumerate((range(0, 30), range(20, 50), range(10, 60))):
        rows = prints(spark, numbers).withColumn("arrival", F.substring("session_id", 2, 9).cast("long")).drop("experience_id")
        rows.write.parquet(str(tmp_path / f"in{k}"))
        sync.run_batches(spark.readStream.schema(schema).parquet(str(tmp_path / f"in{k}")), sync.ledger_dedup(out), str(tmp_path / f"check{k}"))
        if k == 1:
            lg.compact(spark, out, lg._batches(spark, f"{out}/fingerprints"))
    assert sessions(lg.read_ledger(spark, out)) == sorted(f"s{n}" for n in range(60))
