"""Cases that the derived tables do not hold."""

import datetime as dt
import fnmatch
import json

import pytest
from pyspark.sql import functions as F

from tracelake.functions import text as tx
from tracelake.functions.redact import redact_tree
from tracelake.operators import cards as cd
from tracelake.operators import consent as cs
from tracelake.operators import governance as gv
from tracelake.operators import rewards as rw
from tracelake.operators.scan import first_rows
from tracelake.session import SHARED_DIR_CONF, shared_dir
from tracelake.sources import chat, listing
from tracelake.streaming import sync

TURNS = ("session_id string, turn_index long, role string, content string, ts string, "
         "tool_calls array<struct<id:string,name:string,input:string>>, tool_result_for string")


def one(spark, values, expr, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"c {kind}").select(expr(F.col("c"))).collect()]


def test_globs_like_fnmatch(spark):
    globs = ["/w/*", "/w/[ab]*", "/w/[!ab]?", "/w/[", "/w/[]x]", "/w/a[b", "/w/[z-a]q", "/w/[!z-a]", "/w/[*.?]", "/w/a.b", "/w/(x)+", "/w/é?", "/w/[a-c^]"]
    paths = ["/w/a", "/w/b1", "/w/c1", "/w/[", "/w/x", "/w/]", "/w/a[b", "/w/q", "/w/*", "/w/.", "/w/a.b", "/w/axb", "/w/(x)+", "/w/éß", "/w/^", "/w/cc"]
    rules = spark.createDataFrame([(g,) for g in globs], "g string").withColumn("r", cs.glob_regex(F.col("g")))
    got = rules.crossJoin(spark.createDataFrame([(p,) for p in paths], "p string")).filter("p RLIKE r").select("g", "p").collect()
    assert {(r.g, r.p) for r in got} == {(g, p) for g in globs for p in paths if fnmatch.fnmatchcase(p, g)}


def test_judge_replies_are_one_object(spark):
    bad = ['{"outcome": 1} or maybe {"outcome": -1}', "{'outcome': 1}", '{"outcome": 1,}', "{}}", "none"]
    assert one(spark, bad, rw.parse_judge_reply) == [None] * len(bad)
    good = spark.createDataFrame([('x {"outcome": 1, "confidence": true} y',), ('{"confidence": false}',)], "raw string")
    assert [r.confidence for r in rw.validate_reward(good)[0].collect()] == [1.0, 0.0]


def test_revoke_keeps_earlier_times(spark):
    rows = [("x1", "o", "p1", "auto_approved", None), ("x2", "o", None, "revoked", "2020-01-01T00:00:00"), ("x3", "o", "p3", "auto_approved", None)]
    exp = spark.createDataFrame(rows, "experience_id string, owner string, trajectory_path string, review_status string, revoked_at string")
    asked = spark.createDataFrame([("x1", "o"), ("x2", "o")], "experience_id string, owner string")
    got = {r.experience_id: (r.revoked_at, r.review_status) for r in gv.revoke(exp, asked, dt.datetime(2024, 5, 1)).collect()}
    assert got == {"x1": ("2024-05-01T00:00:00", "revoked"), "x2": ("2020-01-01T00:00:00", "revoked"), "x3": (None, "auto_approved")}


def test_deeply_nested_json_is_still_redacted(spark):
    deep = "[" * 100_000 + '"ann@example.com"' + "]" * 100_000
    got = spark.createDataFrame([(deep,), (json.dumps({"a": "bob@example.com"}),)], "j string").select(redact_tree()("j").alias("r")).collect()
    assert all("@example.com" not in r.r["json"] and r.r["hits"] == {"email": 1} for r in got)


def test_fingerprint_ignores_turn_numbers(spark):
    def of(numbers):
        rows = [("s", n, "user", f"text {i}", "", [], "") for i, n in enumerate(numbers)]
        return cd.fingerprint(spark.createDataFrame(rows, TURNS)).first()["fingerprint"]
    assert of([0, 1, 2]) == of([0, 2, 5]) == of([7, 70_000, 700_000])
    assert of([0, 1, 2]) != of([2, 1, 0])


def test_unicode_blanks(spark):
    wide = "\u3000\u00a0\u2003 "
    assert one(spark, [wide, "", " a"], tx.is_blank) == [True, True, False]
    assert one(spark, [wide + "a" + wide + "b" + wide], tx.flatten_ws) == ["a b"]
    assert one(spark, [wide + "修复登录。" + wide], tx.heuristic_title) == ["修复登录。"]


def test_steps_come_in_parts(spark):
    rows = [("s", i, "assistant", f"step {i}", "", [], "") for i in range(7)]
    turns = spark.createDataFrame(rows, TURNS)
    got = cd.attach_steps(cd.card_build(turns), cd.card_steps(turns), part=3).orderBy("part_no").collect()
    assert [(r.part_no, len(r.steps), r.n_steps) for r in got] == [(0, 3, 7), (1, 3, 7), (2, 1, 7)]


def test_listings_have_no_hidden_limit(spark, tmp_path):
    rows = [(i, f"a{i % 3}", "b", "x", "", "", f"2024-01-01T00:{i // 60:02d}:{i % 60:02d}", f"t1{i % 2}") for i in range(900)]
    m = spark.createDataFrame(rows, "id long, sender string, recipient string, content string, workflow string, stage string, ts string, thread_id string")
    assert chat.find_thread(m, "t1").count() == 900 and chat.find_thread(m, "t1", 500).count() == 500
    assert {(r.thread_id, r.msg_count, r.n_senders) for r in chat.list_threads(m).collect()} == {("t10", 450, 3), ("t11", 450, 3)}
    (tmp_path / "f.bin").write_bytes(b"x" * 5000)
    assert listing.raw_manifest(spark, str(tmp_path)).first()["raw_sha256"] is not None
    assert listing.raw_manifest(spark, str(tmp_path), cap=10).first()["raw_truncated"]


def test_repeated_deep_results_give_one_row(spark):
    waiting = spark.createDataFrame([("x", "layer1_only", None)], "experience_id string, sanitization_status string, strict_redactions string")
    results = spark.createDataFrame([("x", "name:1"), ("x", "name:2")], "experience_id string, strict_redactions string")
    assert [tuple(r) for r in sync.deep_drain(waiting, results).collect()] == [("x", "done", "name:2")]


def test_two_streams_and_a_dated_batch_share_a_ledger(spark, tmp_path):
    out = str(tmp_path / "out")
    spark.createDataFrame([("a", "f0", "s0", "x0")], "agent_id string, fingerprint string, session_id string, experience_id string").write.parquet(
        f"{out}/fingerprints/batch=2024-01-01")
    for k, prints in enumerate((["f0", "f1"], ["f1", "f2"])):
        rows = spark.createDataFrame([("a", p, f"s{k}{p}", k * 10 + i) for i, p in enumerate(prints)],
                                     "agent_id string, fingerprint string, session_id string, arrival long")
        rows.write.parquet(str(tmp_path / f"in{k}"))
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / f"in{k}"))
        sync.run_batches(stream, sync.ledger_dedup(out), str(tmp_path / f"check{k}"))
    got = sorted(r.fingerprint for r in spark.read.parquet(f"{out}/fingerprints").collect())
    assert got == ["f0", "f1", "f2"]


def test_no_shared_folder_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()
    with pytest.raises(ValueError, match=SHARED_DIR_CONF):
        shared_dir(Session(), "x")


@pytest.mark.parametrize("n", [3, 1500])
def test_first_rows_of_a_hot_key(spark, n):
    rows = [("hot" if i % 10 else f"k{i % 3}", (i * 7919) % 10_007, i) for i in range(9000)]
    df = spark.createDataFrame(rows, "k string, a long, b long").repartition(4)
    got = first_rows(df, ["k"], [F.col("a"), F.col("b")], n).collect()
    want = [r for k in {r[0] for r in rows} for r in sorted((x for x in rows if x[0] == k), key=lambda x: x[1:])[:n]]
    assert sorted(map(tuple, got)) == sorted(want)
