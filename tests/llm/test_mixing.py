from tests.llm.brute import poisson_copies
from tracelake.llm.mixing import mix, rates

SCHEMA = "doc_id long, text string, source string, copy string"


def test_counts_order_and_columns(spark):
    rows = [(i, "t", "big" if i % 3 else f"s{i % 5}", "old") for i in range(900)] + [(2000 + i, "t", None, None) for i in range(40)]
    got = mix(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    want = poisson_copies([(i, s) for i, _, s, _ in rows])
    counts = {}
    for r in got:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {i: n for i, n in want.items() if n}
    assert [r.shuffle_key for r in got] == sorted(r.shuffle_key for r in got)
    assert sorted(r.copy for r in got if r.doc_id == max(counts, key=counts.get)) == list(range(max(counts.values())))


def test_target_weights_are_met(spark):
    rows = [(i, "t", "a" if i < 9000 else "b", "") for i in range(10_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mix(df, {"a": 1.0, "b": 3.0}, size=20_000, seed=3).groupBy("source").count().collect()
    n = {r["source"]: r["count"] for r in got}
    assert abs(n["a"] - 5000) < 300 and abs(n["b"] - 15_000) < 500
    assert mix(df, {"b": 1.0}).select("source").distinct().collect()[0][0] == "b"


def test_large_rates_and_odd_rows(spark):
    rows = [(1, "x", "a", ""), (2, None, "b", ""), (None, "y", "b", ""), (None, None, "b", ""), (3, "z", "b", ""), (3, "z", "b", "")]
    got = mix(spark.createDataFrame(rows, SCHEMA), {"a": 1.0, "b": 1.0}, size=6000).groupBy("source").count().collect()
    n = {r["source"]: r["count"] for r in got}
    assert abs(n["a"] - 3000) < 300 and abs(n["b"] - 3000) < 300
    top = rates(spark.createDataFrame(rows, SCHEMA), {"a": 1.0, "b": 1.0}, size=6000).collect()
    assert all(abs(r.cdf[-1] - 1) < 1e-9 for r in top)
    assert mix(spark.createDataFrame([], SCHEMA)).collect() == []


def test_plan_has_no_python(spark):
    plan = mix(spark.createDataFrame([(1, "x", "a", "")], SCHEMA))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_names_of_the_input_do_not_matter(spark):
    names = ["doc_id", "source", "text", "_rate", "_cdf", "_key", "_count", "_source", "key", "n", "cdf", "c0", "Copy", "SHUFFLE_KEY", "rate"]
    rows = [(i, f"s{i % 3}", f"t{i}", *[f"{c}{i}" for c in names[3:]]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, source string, " + ", ".join(f"`{c}` string" for c in names[2:]))
    out = mix(df, size=900)
    assert out.columns == names[:12] + ["copy", "rate", "shuffle_key"]
    by = {r[0]: r for r in rows}
    got = out.collect()
    assert len(got) > 700
    assert all(tuple(r)[:12] == by[r["doc_id"]][:12] and r["rate"] > 0 and len(r["shuffle_key"]) == 32 for r in got)
    assert [r["shuffle_key"] for r in got] == sorted(r["shuffle_key"] for r in got)
