"""Source name -> reader, and one merged turns table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.sources import event_log, messages, rollout
from tracelake.sources.chat import chat_to_turns

Reader = Callable[..., DataFrame]


def _chat(spark: SparkSession, path: str, **options) -> DataFrame:
    return chat_to_turns(spark.read.parquet(path), **options)


READERS: dict[str, Reader] = {
    "event_log": event_log.read_event_jsonl,
    "event_blocks": event_log.read_event_blocks,
    "rollout": rollout.read_rollout_jsonl,
    "role_jsonl": messages.read_role_jsonl,
    "json_bundle": messages.read_json_bundle,
    "chat_table": _chat,
    "history_items": messages.read_history_items,
    "interpreter": messages.read_any_chat,
    "enriched": messages.read_enriched_jsonl,
    "markdown": messages.read_markdown_chat,
    "generic": messages.read_any_chat,
}


def register_reader(name: str, reader: Reader) -> None:
    READERS[name] = reader


def read_traces(spark: SparkSession, sources: dict[str, str | list[str]]) -> DataFrame:
    """{source: path or paths} -> one turns table with a ``source`` column. A session id is
    made unique by its source."""
    parts = []
    for name, paths in sources.items():
        if name not in READERS:
            raise ValueError(f"unknown source {name!r}; known: {sorted(READERS)}")
        for path in [paths] if isinstance(paths, str) else paths:
            parts.append(READERS[name](spark, path).withColumn("source", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
