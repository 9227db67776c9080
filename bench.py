"""Timed headline queries; prints one JSON line.

Every query is forced with the noop sink: one warm-up, then the median of three runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tracelake import suite  # noqa: E402
from tracelake.session import local_session  # noqa: E402

HEADLINE = (
    "card_build", "card_with_steps", "fingerprint", "dedup_sessions", "dedup_ledger_antijoin",
    "redact_text", "redaction_counts", "rule_hit_report", "credit_card_luhn", "strict_public_audit",
    "evaluable_pairs", "select_turns_even", "subsequent_context", "judge_input", "pack_transcript",
    "segment_tasks", "validate_reward", "reward_summary", "consent_decide", "cosine_topk",
    "acl_filtered_search", "read_event_jsonl", "read_event_blocks", "read_rollout_jsonl",
    "read_any_chat", "read_chat_table", "merge_seen_ids", "quota", "stream_redact", "stream_dedup_exact",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [k for k in os.environ.get("BENCH_KEYS", "").split(",") if k]
    spark = local_session(cpus, "tracelake-bench")
    spark.sparkContext.setLogLevel("ERROR")
    suite.load()
    times = {}
    for key in only or HEADLINE:
        taken = []
        for _ in range(runs + 1):
            t = time.perf_counter()
            suite.QUERIES[key](spark, sf).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - t)
        times[key] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
