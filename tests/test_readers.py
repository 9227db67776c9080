"""Small hand-written files per format, with the expected turns."""

import json

from pyspark.sql import functions as F

from tracelake.operators.consent import policy_tables
from tracelake.sources import event_log, listing, messages, registry, rollout
from tracelake.streaming import sync


def write(path, *rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in rows), encoding="utf-8")


def show(df, *extra):
    cols = ["role", "content", *extra]
    return [tuple(r[c] for c in cols) for r in df.orderBy("session_id", "turn_index").collect()]


EVENTS = [
    {"type": "user", "message": {"role": "user", "content": "hello"}, "timestamp": "t1", "version": "1", "cwd": "/w"},
    "{broken", "", {"type": "summary", "summary": "x"},
    {"type": "assistant", "timestamp": "t2", "message": {"role": "assistant", "model": "m1", "content": [
        {"type": "text", "text": "first"}, {"type": "thinking", "thinking": "hmm", "signature": "zz"}, {"type": "thinking", "thinking": ""},
        {"type": "tool_use", "id": "toolu_0123456789", "name": "Bash", "input": {"z": 1, "a": "x"}}, "bare", {"type": "text", "text": " "},
        {"type": "text", "text": "second"}]}},
    {"type": "user", "timestamp": "t3", "message": {"role": "user", "content": [
        {"type": "tool_result", "tool_use_id": "toolu_0123456789", "content": [{"type": "text", "text": "a"}, {"type": "image"}, {"type": "text", "text": "b"}], "is_error": True},
        {"type": "tool_result", "tool_use_id": "k2", "content": {"b": 1}}, {"type": "tool_result", "tool_use_id": "k3", "content": "[x]"},
        {"type": "text", "text": "[Request interrupted by user]"}]}},
    {"type": "user", "message": {"role": "user", "model": "<synthetic>", "content": "skip me"}},
    {"type": "assistant", "message": {"role": "assistant", "model": "<synthetic>", "content": [{"type": "text", "text": "line sep kept"}]}},
]


def test_event_log(spark, tmp_path):
    write(tmp_path / "p" / "abc.jsonl", *EVENTS)
    (tmp_path / "p" / "empty.jsonl").write_text("")
    df = event_log.read_event_jsonl(spark, str(tmp_path))
    assert show(df, "tool_result_for") == [
        ("user", "hello", ""), ("assistant", "💭 思考\n\nhmm", ""), ("assistant", "first\nsecond", ""),
        ("tool", "a\nb", "toolu_0123456789"), ("tool", '{"b": 1}', "k2"), ("tool", "[x]", "k3"), ("assistant", "line sep kept", "")]
    assert [r[0] for r in df.orderBy("turn_index").select("turn_index").collect()] == list(range(7))
    calls = df.filter(F.size("tool_calls") > 0).first()["tool_calls"]
    assert [tuple(c) for c in calls] == [("toolu_0123456789", "Bash", '{"z":1,"a":"x"}')]
    from tracelake.sources.base import read_lines
    meta = event_log.event_meta(read_lines(spark, str(tmp_path), "abc.jsonl")).first()
    assert (meta["started_at"], meta["ended_at"], meta["model"], meta["cwd"]) == ("t1", "t3", "m1", "/w")


def test_event_log_in_many_splits(spark, tmp_path):
    rows = [{"type": "user", "message": {"role": "user", "content": f"line {i}"}} for i in range(300)]
    write(tmp_path / "big.jsonl", *rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = event_log.read_event_jsonl(spark, str(tmp_path))
        assert [c for _, c in show(df)] == [f"line {i}" for i in range(300)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_event_blocks(spark, tmp_path):
    write(tmp_path / "abc.jsonl", *EVENTS)
    got = show(event_log.read_event_blocks(spark, str(tmp_path)))
    assert got[:5] == [
        ("user", "hello"), ("assistant", "first"), ("assistant", "💭 思考\n\nhmm"),
        ("assistant", '🔧 调用工具: Bash  (id=toolu_012345)\n\n```json\n{\n  "z": 1,\n  "a": "x"\n}\n```'), ("assistant", "second")]
    assert got[5] == ("tool", "📤 工具返回 ❌  (id=toolu_012345)\n\na\n[image]\nb")
    assert got[6] == ("tool", '📤 工具返回  (id=k2)\n\n{"b": 1}')


def test_rollout(spark, tmp_path):
    item = lambda p: {"timestamp": "t", "type": "response_item", "payload": p}
    write(tmp_path / "r.jsonl",
          {"timestamp": "t0", "type": "session_meta", "payload": {"model": "m", "cwd": "/r"}},
          item({"type": "message", "role": "developer", "content": [{"type": "input_text", "text": "sys"}]}),
          item({"type": "message", "role": "user", "content": "plain"}),
          item({"type": "message", "role": "other", "content": "no"}),
          item({"type": "reasoning", "summary": [{"text": "a"}, "b", {"text": " "}], "encrypted_content": "zz"}),
          item({"type": "function_call", "name": "sh", "arguments": '{"b": 1, "a": 2}', "call_id": "c1"}),
          item({"type": "function_call", "arguments": "not json", "call_id": "c2"}),
          item({"type": "function_call_output", "output": '{"output": "fine", "x": 1}', "call_id": "c1"}),
          item({"type": "function_call_output", "output": "raw", "call_id": "c2"}),
          {"type": "event_msg", "payload": {"type": "agent_message"}}, {"role": "assistant", "content": "old"})
    df = rollout.read_rollout_jsonl(spark, str(tmp_path))
    assert show(df, "tool_result_for") == [
        ("system", "sys", ""), ("user", "plain", ""), ("assistant", "💭 思考\n\na\n\nb", ""), ("assistant", "", ""), ("assistant", "", ""),
        ("tool", "fine", "c1"), ("tool", "raw", "c2"), ("assistant", "old", "")]
    assert [tuple(c) for r in df.orderBy("turn_index").collect() for c in r["tool_calls"]] == [
        ("c1", "sh", '{"b":1,"a":2}'), ("c2", "tool", '"not json"')]


def test_other_formats(spark, tmp_path):
    write(tmp_path / "role" / "a.jsonl", {"role": "user", "content": "hi", "ts": "t"}, {"role": "user", "content": " "},
          {"type": "assistant", "content": [{"type": "tool_use", "id": "1", "name": "n", "input": {}}]},
          {"role": "tool", "content": [{"type": "tool_result", "tool_use_id": "1", "content": "out"}]}, {"role": "user", "content": {"k": 1}})
    write(tmp_path / "role" / "request_dump_1.jsonl", {"role": "user", "content": "no"})
    assert show(messages.read_role_jsonl(spark, str(tmp_path / "role")), "tool_result_for") == [
        ("user", "hi", ""), ("assistant", "", ""), ("tool", "out", "1"), ("user", '{"k": 1}', "")]
    write(tmp_path / "bundle" / "b.json", {"session_id": "B", "messages": [], "history": [
        {"role": "system", "content": "s"}, {"role": "user", "content": [{"type": "text", "text": "x"}, {"type": "image"}]}, {"content": "d"}]})
    assert show(messages.read_json_bundle(spark, str(tmp_path / "bundle"))) == [("user", "x"), ("user", "d")]
    write(tmp_path / "hist" / "h.json", {"history": [{"message": {"role": "assistant", "content": "a"}}, {"message": {"role": "user", "content": ""}}]})
    assert show(messages.read_history_items(spark, str(tmp_path / "hist"))) == [("assistant", "a")]
    write(tmp_path / "md" / "proj" / "c.md", "# start", "#### ask one", "answer", "more", "", "####  ask two")
    md = messages.read_markdown_chat(spark, str(tmp_path / "md"))
    assert show(md) == [("user", "ask one"), ("assistant", "answer\nmore"), ("user", "ask two")]
    assert md.first()["session_id"] == "proj"
    write(tmp_path / "enr" / "e.jsonl", {"composer_id": "ABC1", "trajectory": [{"role": "", "content": "x"}, {"role": "assistant", "content": ""}]},
          {"id": "zzz", "messages": [{"role": "user", "content": "other"}]})
    assert show(messages.read_enriched_jsonl(spark, str(tmp_path / "enr"), "abc")) == [("user", "x"), ("assistant", "")]


def test_generic_shapes(spark, tmp_path):
    m = [{"role": "human", "content": "q"}, {"name": "bot1", "content": "a"}]
    write(tmp_path / "a_lines.jsonl", *m)
    write(tmp_path / "b_list.json", m)
    write(tmp_path / "c_key.json", {"chat_history": m, "session_id": "c_key"})
    write(tmp_path / "d_req.json", {"request": {"body": {"messages": m}}})
    write(tmp_path / "e_one.json", {"role": "user", "content": "single"})
    write(tmp_path / "f_text.txt", "  just text ")
    write(tmp_path / "g_runs.json", {"runs": [{"inputs": {"messages": m[:1]}, "outputs": {"o": 1}}]})
    got = {}
    for r in registry.read_traces(spark, {"generic": str(tmp_path)}).orderBy("turn_index").collect():
        got.setdefault(r["session_id"].split("@")[0], []).append((r["role"], r["content"]))
    two = [("user", "q"), ("assistant", "a")]
    assert got == {"a_lines": two, "b_list": two, "c_key": two, "d_req": two, "e_one": [("user", "single")],
                   "f_text": [("user", "just text")], "g_runs": [("user", "q"), ("assistant", '{"o": 1}')]}


def test_manifest(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    (tmp_path / "b.bin").write_bytes(b"x" * 100)
    got = {r["path"][-5:]: (r["raw_size_bytes"], r["raw_truncated"], (r["raw_sha256"] or "")[:8])
           for r in listing.raw_manifest(spark, str(tmp_path), cap=50).collect()}
    assert got == {"a.bin": (3, False, "ba7816bf"), "b.bin": (100, True, "")}


def test_stream_equals_batch_and_is_idempotent(spark, tmp_path):
    for i in range(4):
        write(tmp_path / "in" / f"s{i}.jsonl", {"type": "user", "message": {"role": "user", "content": f"task {i % 3} a@example.com"}},
              {"type": "assistant", "message": {"role": "assistant", "content": [{"type": "text", "text": "ok"}]}})
    out, cp = str(tmp_path / "gold"), str(tmp_path / "cp")

    always = policy_tables(spark, {"mode": "always"})

    def run(policy=always):
        sync.stream_sync(spark, str(tmp_path / "in"), out, cp, "a1", policy, max_files=2).awaitTermination()
        cards = spark.read.parquet(f"{out}/cards")
        return sorted((r["session_id"], r["query"]) for r in cards.collect())

    first = run()
    assert len(first) == 3 and all("<EMAIL>" in q for _, q in first)      # one of the copies is dropped
    assert run() == first                                                # nothing new: nothing added
    write(tmp_path / "in" / "s1b.jsonl", {"type": "user", "message": {"role": "user", "content": "task 1 a@example.com"}},
          {"type": "assistant", "message": {"role": "assistant", "content": [{"type": "text", "text": "ok"}]}},
          {"type": "user", "message": {"role": "user", "content": "more"}})
    assert len(run()) == 4                                               # grown content is a new row
    write(tmp_path / "in" / "held.jsonl", {"type": "user", "message": {"role": "user", "content": "never seen before"}})
    assert len(run(None)) == 4                                           # without a policy nothing passes
    assert {r["status"] for r in spark.read.parquet(f"{out}/outcomes").collect()} == {"uploaded", "skipped_consent"}


def test_equal_names_in_two_folders_are_two_sessions(spark, tmp_path):
    for folder in ("p1", "p2"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "chat.jsonl").write_text("".join(
            '{"type":"user","message":{"role":"user","content":"%s %d"}}\n' % (folder, i) for i in range(3)))
    from tracelake.sources.event_log import read_event_jsonl
    got = read_event_jsonl(spark, str(tmp_path)).groupBy("session_id").agg(
        F.sort_array(F.collect_list("turn_index")).alias("n"), F.countDistinct(F.substring("content", 1, 2)).alias("folders")).collect()
    assert len(got) == 2 and all(r["session_id"].startswith("chat@") and r["n"] == [0, 1, 2] and r["folders"] == 1 for r in got)
