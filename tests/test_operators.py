"""Brute-force comparisons on small made-up sessions, with tiny chunks so that every carry is used."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tracelake.functions import text as tx
from tracelake.operators import cards as cd
from tracelake.operators import consent as cs
from tracelake.operators import governance as gv
from tracelake.operators import pairs as pr
from tracelake.operators import rewards as rw
from tracelake.operators import scan, search
from tracelake.plans import jobs
from tracelake.schema import TURNS


def sessions(n=6, length=40, seed=3):
    rnd = random.Random(seed)
    out = []
    for s in range(n):
        for i in range(rnd.randint(1, length)):
            role = rnd.choice(["user", "assistant", "assistant", "tool", "system"])
            content = rnd.choice(["", " ", "hello there", "x" * rnd.randint(1, 30), "two\nlines"])
            calls = [{"id": f"c{i}", "name": "Bash", "input": '{"a":1,"b":[1,2]}'}] if role == "assistant" and rnd.random() < .3 else []
            out.append((f"s{s}", i, role, content, "", calls, ""))
    return out


@pytest.fixture(params=[2, 65_536], ids=["tiny-chunks", "one-chunk"])
def chunk(request, monkeypatch):
    monkeypatch.setattr(scan, "CHUNK", request.param)
    monkeypatch.setattr(pr, "CONTEXT_CHUNK", max(4, request.param))
    return request.param


def by_session(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def pairs_of(turns):
    pairs, pending = [], None
    for t in turns:
        if t[2] == "user" and t[3].strip():
            pending = t[1]
        elif t[2] == "assistant" and pending is not None:
            pairs.append((pending, t[1]))
            pending = None
    return pairs


def test_pairs_and_even(spark, chunk):
    rows = sessions()
    p = pr.evaluable_pairs(spark.createDataFrame(rows, TURNS)).cache()
    got = {}
    for r in p.orderBy("session_id", "pair_no").collect():
        got.setdefault(r["session_id"], []).append((r["user_idx"], r["assistant_idx"]))
    want = {s: x for s, t in by_session(rows).items() if (x := pairs_of(t))}
    assert got == want
    even = {}
    for r in pr.select_turns_even(p, 4).orderBy("session_id", "pair_no").collect():
        even.setdefault(r["session_id"], []).append(r["pair_no"] - 1)
    for s, x in want.items():
        n, m = len(x), 4
        idx = list(range(n)) if n <= m else sorted({0, n - 1, *(round(i * ((n - 1) / (m - 1))) for i in range(m))})[:m]
        assert even[s] == idx


def test_subsequent(spark, chunk):
    rows = sessions(seed=8)
    df = spark.createDataFrame(rows, TURNS)
    got = {(r["session_id"], r["assistant_idx"]): r["subsequent"]
           for r in pr.subsequent_context(df, pr.evaluable_pairs(df), 3).collect()}
    for s, turns in by_session(rows).items():
        for _, a in pairs_of(turns):
            out = []
            for t in turns:
                if t[1] <= a or t[2] not in ("user", "assistant") or not (t[3].strip() or t[5]):
                    continue
                if t[2] == "user":
                    out.append("User: " + t[3])
                else:
                    parts = ([t[3]] if t[3] else []) + ['[Tool: Bash] {"a": 1, "b": [1, 2]}' for _c in t[5]]
                    out.append("Assistant: " + "\n".join(parts).strip())
            assert got[(s, a)] == "\n\n".join(out[:3])


def test_pack(spark, chunk):
    rows = sessions(seed=5)
    got = {r["session_id"]: r["transcript"] for r in pr.pack_transcript(spark.createDataFrame(rows, TURNS), 90).collect()}
    for s, turns in by_session(rows).items():
        out, used = [], 0
        for t in turns:
            c = t[3].strip()
            if not c and not t[5]:
                continue
            line = {"user": f"[用户] {c}", "tool": "[工具结果] " + c.replace("\n", " ")}.get(t[2])
            if t[2] == "assistant":
                line = "[助手→工具] Bash" if t[5] else f"[助手] {c}"
            if line is None:
                continue
            if used + len(line) > 90:
                out.append("...(truncated)")
                break
            out.append(line)
            used += len(line) + 1
        if out:
            assert got[s] == "\n".join(out), s


def test_fingerprint_ignores_time_and_order_of_arrival(spark):
    rows = sessions()
    a = cd.fingerprint(spark.createDataFrame(rows, TURNS)).select("session_id", "fingerprint")
    moved = [(*r[:4], "2030-01-01", *r[5:]) for r in reversed(rows)]
    b = cd.fingerprint(spark.createDataFrame(moved, TURNS).repartition(5)).select("session_id", "fingerprint")
    assert sorted(a.collect()) == sorted(b.collect())
    swapped = [("s", 0, "user", "a", "", [], ""), ("s", 1, "user", "b", "", [], "")]
    other = [("s", 0, "user", "b", "", [], ""), ("s", 1, "user", "a", "", [], "")]
    f = [cd.fingerprint(spark.createDataFrame(x, TURNS)).first()["fingerprint"] for x in (swapped, other)]
    assert f[0] != f[1]


def test_card_rules(spark):
    rows = [("s", 0, "user", "<command-name>x", "", [], ""), ("s", 1, "user", "Fix it. Mail ann@example.com", "", [], ""),
            ("s", 2, "assistant", "done " + "y" * 600, "", [{"id": "1", "name": "Bash", "input": '{"p":"/home/ann/x"}'}], ""),
            ("e", 0, "tool", "t", "", [], "")]
    cards = {r["session_id"]: r for r in cd.card_build(spark.createDataFrame(rows, TURNS)).collect()}
    c = cards["s"]
    assert (c["query"], c["intent"]) == ("Fix it. Mail <EMAIL>", "Fix it.")
    assert len(c["outcome"]) == 500 and c["redactions"] == {"email": 1, "home_path": 1}
    assert cards["e"]["query"] == "(no user turn)" and cards["e"]["outcome"] == "(no assistant turn)"
    steps = cd.attach_steps(cd.card_build(spark.createDataFrame(rows, TURNS)),
                            cd.card_steps(cd.redact_turns(spark.createDataFrame(rows, TURNS))))
    assert {(r["session_id"], r["part_no"]): [x[:4] for x in r["steps"]] for r in steps.collect()} == {("s", 0): ["done"], ("e", 0): []}


def test_titles(spark):
    cases = [("[task-summary]: Fix the login.", "Fix the login"), ("[TASK-SUMMARY]： \"Deploy A\" \n more", "Deploy A"),
             ("[task-summary]: sure, ok", None), ("x [task-summary]: no", None)]
    got = [r[0] for r in spark.createDataFrame([(c,) for c, _ in cases], "c string").select(tx.marker_label(F.col("c"))).collect()]
    assert got == [w for _, w in cases]


@pytest.mark.parametrize("raw,want", [
    ('{"outcome":1,"confidence":0.7}', (1, 0.7)), ('```json\n{"outcome": "1"}\n```', (1, 0.5)),
    ('ok {"outcome": 9, "confidence": 7} bye', (1, 1.0)), ('{"outcome": "x", "confidence": "bad"}', (0, 0.5)),
    ('{"outcome": -0.9}', (0, 0.5)), ("nothing", None), ("{}", None)])
def test_rewards(spark, raw, want):
    ok, bad = rw.validate_reward(spark.createDataFrame([("x", raw)], "experience_id string, raw string"))
    rows = ok.collect()
    assert ([(r["outcome"], r["confidence"]) for r in rows] or None) == ([want] if want else None)
    assert bad.count() == (0 if want else 1)


def test_consent_decisions(spark):
    now = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)
    policy = {"mode": "ask", "agents": {"a": {"mode": "always"}, "b": {"mode": "never"}},
              "cwd_rules": [{"glob": "/w/**", "mode": "always"}, {"glob": "/w/*/secret", "mode": "never"}, {"glob": "/q/?", "mode": "dry-run"}],
              "session_overrides": {"o1": {"mode": "always", "expires_at": "2024-01-02T00:00:00+00:00"},
                                    "o2": {"mode": "always", "expires_at": "2023-01-02T00:00:00"}, "o3": {"mode": "always", "expires_at": "x"}}}
    rows = [("s1", "c", "/w"), ("s2", "c", "/w/x/secret"), ("s3", "b", "/w/y"), ("s4", "a", "/none"), ("s5", "c", "/q/1"),
            ("s6", "c", "/q/12"), ("o1", "b", "/w"), ("o2", "b", "/w"), ("o3", "c", "/wx")]
    df = spark.createDataFrame(rows, "session_id string, agent string, cwd string")
    over, cwds, agents, top = cs.policy_tables(spark, policy)
    got = {r["session_id"]: (r["mode"], r["reason"]) for r in cs.consent_decide(df, over, cwds, agents, top, now).collect()}
    assert got == {
        "s1": ("always", "cwd_rule:/w/**"), "s2": ("never", "cwd_rule:/w/*/secret"), "s3": ("never", "agent:b"),
        "s4": ("always", "agent:a"), "s5": ("dry-run", "cwd_rule:/q/?"), "s6": ("ask", "global"),
        "o1": ("always", "session_override"), "o2": ("never", "agent:b"), "o3": ("ask", "global")}
    hard = {r["session_id"]: r["mode"] for r in cs.consent_decide(df, over, cwds, agents, top, now, never_is_absolute=True).collect()}
    assert hard["o1"] == "never"
    with pytest.raises(ValueError):
        cs.policy_tables(spark, {"mode": "maybe"})


def test_cells_equal_full_scan(spark):
    rnd = random.Random(1)
    vecs = [(i, [rnd.gauss(i % 5, 1) for _ in range(8)]) for i in range(400)]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>")
    qs = spark.createDataFrame([(f"q{i}", v) for i, v in vecs[:20]], "query_id string, query_vec array<double>")
    cells, pivots = search.build_cells(df, 12)
    a = search.cosine_topk(qs, df, 6).orderBy("query_id", "rank_no").collect()
    b = search.cell_topk(qs, cells, pivots, 6, probe=2).orderBy("query_id", "rank_no").collect()
    assert [(r[0], r[1], round(r[2], 9)) for r in a] == [(r[0], r[1], round(r[2], 9)) for r in b]


def test_search_in_query_blocks(spark, monkeypatch):
    df = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(50)], "vec_id long, embedding array<double>")
    qs = spark.createDataFrame([(f"q{i}", [float(i), 2.0]) for i in range(9)], "query_id string, query_vec array<double>")
    whole = search.cosine_topk(qs, df, 4).orderBy("query_id", "rank_no").collect()
    for name, value in (("QUERY_BLOCK", 4), ("MAX_QUERY_CELLS", 6), ("TILE_CELLS", 60)):
        monkeypatch.setattr(search, name, value)
        assert search.cosine_topk(qs, df, 4).orderBy("query_id", "rank_no").collect() == whole


def test_many_wide_queries(spark):
    """Blocks follow the dimension: no number of queries is refused."""
    df = spark.range(300).select(F.col("id").alias("vec_id"), F.transform(F.sequence(F.lit(0), F.lit(767)), lambda i: F.cos(i * F.col("id"))).alias("embedding"))
    qs = df.select((F.col("vec_id") * 100).alias("query_id"), F.col("embedding").alias("query_vec")).join(spark.range(20).select("id"))
    qs = qs.select(F.concat_ws("-", "query_id", "id").alias("query_id"), "query_vec")
    got = search.cosine_topk(qs, df, 2)
    assert got.count() == 12_000 and got.filter("rank_no = 1 AND similarity < 0.999999").count() == 0


def test_tick(spark):
    now = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    turns = spark.createDataFrame([(s, 0, "user", c, "", [], "") for s, c in
                                   (("a", "hi"), ("b", " <transcript>x"), ("c", "hi"), ("d", "hi"), ("old", "hi"))], TURNS).withColumn("source", F.lit("x"))
    turns = turns.unionByName(turns.filter("session_id = 'a'").withColumn("source", F.lit("y")))
    ses = spark.createDataFrame([("x", s, "ag", "/w" if s != "d" else "/n", f"2024-01-0{i + 1}", 10 if s != "c" else 9_999_999)
                                 for i, s in enumerate(("a", "b", "c", "d", "old"))],
                                "source string, session_id string, agent string, cwd string, mtime string, size_bytes long")
    seen = spark.createDataFrame([("x", "old")], "source string, session_id string")
    policy = cs.policy_tables(spark, {"cwd_rules": [{"glob": "/w/**", "mode": "always"}]})
    ses = ses.unionByName(spark.createDataFrame([("y", "a", "ag", "/n", "2024-01-09", 1), ("x", "none", "ag", "/w", "2024-01-09", 1)], ses.schema))
    out, todo = jobs.tick(turns, ses, seen, policy, now, max_per_source=10, max_kb=4096)
    assert {(r["source"], r["session_id"]): r["status"] for r in out.collect()} == {
        ("x", "a"): "uploaded", ("x", "b"): "skipped_artifact", ("x", "c"): "skipped_size", ("x", "d"): "skipped_consent",
        ("x", "old"): "skipped_seen", ("x", "none"): "skipped_empty", ("y", "a"): "skipped_consent"}
    assert [(r["source"], r["session_id"]) for r in todo.collect()] == [("x", "a")]
    out, todo = jobs.tick(turns, ses, seen, policy, now)
    assert {r["session_id"] for r in todo.collect()} == {"a", "c"}
    out, todo = jobs.tick(turns, ses, seen, policy, now, max_per_source=1)
    assert {r["session_id"]: r["status"] for r in out.filter("source = 'x'").collect()}["c"] == "skipped_cap"
    assert jobs.tick(turns, ses, seen, None, now)[1].count() == 0


@pytest.mark.parametrize("kind", ["long", "string"])
def test_chat_numbering_in_a_hot_hour(spark, monkeypatch, kind):
    from tracelake.sources import chat
    rnd = random.Random(4)
    name = int if kind == "long" else (lambda i: str(i * 6553 % 70001))
    rows = [(name(i), "ann" if i % 3 else "human", "bob", f"m{i}", "", "", rnd.choice(["", "2024-01-01T10:00:00", "2024-01-01T10:00:01", "2024-01-01T11:00:00"]), f"t{i % 2}")
            for i in range(200)]
    df = spark.createDataFrame(rows, f"id {kind}, sender string, recipient string, content string, workflow string, stage string, ts string, thread_id string")
    plain = sorted(chat.chat_to_turns(df).select("session_id", "turn_index", "content").collect())
    monkeypatch.setattr(scan, "CHUNK", 7)
    fine = sorted(chat.chat_to_turns(df, id_chars=2).select("session_id", "turn_index", "content").collect())
    want = []
    for t in ("t0", "t1"):
        mine = sorted((r for r in rows if r[7] == t), key=lambda r: (r[6], r[0]))
        want += [(t, n, f"[{r[1]}→bob] {r[3]}") for n, r in enumerate(mine)]
    assert [tuple(r) for r in plain] == sorted(want)
    assert fine == plain


def test_label_queries_read_past_a_prefix(spark, tmp_path):
    from tracelake import suite

    suite.load()
    far = "word " * 40
    docs = [(6, "\n" * 95 + "Fix the reader"), (12, "\n" * 95 + far), (1, "Fix " + far + "got cut off")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = {r.doc_id: r.label for r in suite.QUERIES["clean_label"](spark, str(tmp_path)).collect()}
    assert labels[6] == "Fix the reader" and labels[12] == far[:59] + "…"
    bad = {r.doc_id: r.bad for r in suite.QUERIES["looks_bad_title"](spark, str(tmp_path)).collect()}
    assert bad[1] and not bad[6]


def test_publish_answers_every_request_and_audits_a_row_once(spark):
    rows = spark.createDataFrame([("x1", "o1", "auto_approved", "on 192.168.0.7 and file:///Users/ann/x"), ("x2", "o1", "auto_approved", "fine"), ("x4", "o1", "revoked", "fine")],
                                 "experience_id string, owner string, review_status string, body string")
    asks = spark.createDataFrame([("x1", "o1"), ("x1", "o2"), ("x2", "o1"), ("x2", "o1"), ("x3", "o1"), ("x4", "o1")], "experience_id string, owner string")
    got = sorted(tuple(r) for r in gv.publish(rows, asks, ["body"]).collect())
    assert got == [("x1", "o1", "blocked", 3), ("x1", "o2", "not_owner", 3), ("x2", "o1", "published", 0), ("x2", "o1", "published", 0),
                   ("x3", "o1", "unknown", 0), ("x4", "o1", "revoked", 0)]
