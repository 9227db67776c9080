"""Shapes of physical plans that must hold at scale."""

import contextlib
import io
import re

import pytest

from tracelake import suite

SF = "/root/testdata/sf0.001"
suite.load()


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def tree(text):
    return text.split("\n\n")[0]


@pytest.mark.parametrize("key", ["card_build", "session_stats", "block_census", "redaction_totals"])
def test_one_shuffle_per_session_graph(spark, key):
    p = tree(plan(suite.QUERIES[key](spark, SF)))
    # the derived turns are a union of two scans; each small input is dealt out once, which
    # does not happen for inputs of many splits
    dealt_out = 2
    assert p.count("Exchange") <= 1 + dealt_out


@pytest.mark.parametrize("key", ["cap_per_source", "cosine_topk", "select_turns_ranked"])
def test_rank_limits_run_before_the_shuffle(spark, key):
    assert plan(suite.QUERIES[key](spark, SF)).count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("key", sorted(suite.QUERIES))
def test_no_cross_or_nested_loop_join(spark, key):
    if key.startswith(("stream_", "write_", "state_", "deep_backfill_stream", "union_sources", "session_memory", "newest_ids", "activity_windows", "deep_queue", "revoke_stored", "reward_upsert_stored")):
        pytest.skip("returns a stored table")
    p = plan(suite.QUERIES[key](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scan_reads_only_what_is_used(spark):
    p = plan(suite.QUERIES["quota"](spark, SF))
    assert "o_totalprice" not in p and "o_orderpriority" not in p
    p = plan(suite.QUERIES["personal_recent"](spark, SF))
    assert "TakeOrderedAndProject" in p


def test_content_is_not_shuffled_for_fingerprints_and_pairs(spark):
    for key in ("fingerprint", "evaluable_pairs"):
        p = plan(suite.QUERIES[key](spark, SF))
        for keys in re.findall(r"Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning", p):
            assert "content" not in keys and "text" not in keys


def test_size_cap_prunes_files_and_unsplit_files_are_read_once(spark, tmp_path):
    from tracelake.sources.base import read_lines
    from tracelake.sources.event_log import read_event_jsonl
    row = '{"type":"user","message":{"role":"user","content":"hi"}}\n'
    (tmp_path / "small.jsonl").write_text(row)
    (tmp_path / "large.jsonl").write_text(row * 3000)
    p = plan(read_event_jsonl(spark, str(tmp_path), max_kb=64))
    assert p.count("Scan text") == p.count("- Scan text") * 2 == 2
    assert (read_lines(spark, str(tmp_path), max_kb=64).rdd.getNumPartitions()
            < read_lines(spark, str(tmp_path)).rdd.getNumPartitions())
    got = read_event_jsonl(spark, str(tmp_path), max_kb=64).collect()
    assert [r["session_id"].split("@")[0] for r in got] == ["small"]


def test_one_session_of_many_chunks(spark):
    from pyspark.sql import functions as F

    from tracelake.operators import cards, pairs
    n = 200_000
    turns = spark.range(n).select(
        F.lit("hot").alias("session_id"), F.col("id").alias("turn_index"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.lit("words here").alias("content"))
    p = pairs.evaluable_pairs(turns)
    r = p.agg(F.count("*").alias("n"), F.max("pair_no").alias("last"), F.max("n_pairs").alias("all"),
              F.count_if(F.col("assistant_idx") - F.col("user_idx") != 1).alias("wrong"),
              F.count_if(F.col("pair_no") != (F.col("user_idx") / 2 + 1)).alias("misnumbered")).first()
    assert tuple(r) == (n // 2, n // 2, n // 2, 0, 0)
    ctx = pairs.subsequent_context(turns, p, 4)
    sizes = {tuple(x) for x in ctx.groupBy(F.size(F.split("subsequent", "\n\n")).alias("k")).count().collect()}
    assert sizes == {(4, n // 2 - 2), (2, 1), (1, 1)}
    assert cards.fingerprint(turns).first()["n_turns"] == n
