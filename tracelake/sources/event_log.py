"""Event-log JSONL: merged turns (one per row plus thinking) and split turns (one per block)."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.functions import text as tx
from tracelake.operators.filters import INTERRUPT, META_TYPES, session_meta
from tracelake.schema import ROLES, THINKING_PREFIX
from tracelake.sources import base as b

LINE = ("type string, timestamp string, version string, cwd string, role string, content array<string>, "
        "message struct<role:string,model:string,content:array<string>>")
ORDER = ["session_id", "block", "seq"]

# Headings of split turns.
CALL_HEAD, RESULT_HEAD, ERROR_MARK, IMAGE = "🔧 调用工具: ", "📤 工具返回", " ❌", "🖼️ [图片]"


def parse_lines(lines: DataFrame) -> DataFrame:
    return b.with_multi(lines).withColumn("j", F.from_json("raw", LINE, b.JSON))


def event_turns(lines: DataFrame) -> DataFrame:
    """Raw lines -> turns in file order. Assistant rows give their thinking blocks first, then
    one turn with the joined text and the calls; user rows give their text and tool results."""
    rows = (parse_lines(lines).filter(F.col("j.type").isin("user", "assistant"))
            .withColumn("bs", b.blocks(F.col("j.message.content"))))
    bs = F.col("bs")
    text = b.join_text(F.transform(b.of_type(bs, "text"), lambda x: F.coalesce(x["f"]["text"], F.lit(""))))
    rows = rows.withColumn("txt", text)
    thinking = F.transform(
        F.filter(b.of_type(bs, "thinking"), lambda x: F.coalesce(x["f"]["thinking"], F.lit("")) != ""),
        lambda x: b.turn("assistant", F.concat(F.lit(THINKING_PREFIX), x["f"]["thinking"])))
    calls = F.transform(b.of_type(bs, "tool_use"), lambda x: b.call_struct(
        x["f"]["id"], x["f"]["name"], x["f"]["input"]))
    said = b.one_if((F.col("txt") != "") | (F.size(calls) > 0), b.turn("assistant", F.col("txt"), calls))
    results = F.transform(b.of_type(bs, "tool_result"), lambda x: b.turn(
        "tool", b.result_text(x), None, x["f"]["tool_use_id"]))
    asked = b.one_if((F.col("txt") != "") & ~F.startswith("txt", F.lit(INTERRUPT)),
                     b.turn("user", F.col("txt")))
    plain = F.when(F.col("j.message.content").isNull(), F.get_json_object("raw", "$.message.content"))
    typed = b.one_if(~tx.is_blank(plain), b.turn("user", plain))
    synthetic = F.coalesce(F.col("j.message.model") == "<synthetic>", F.lit(False))
    turns = (F.when(F.col("j.type") == "assistant", F.concat(thinking, said))
              .when(synthetic, b.no_turns())
              .when(F.col("j.message.content").isNull(), typed)
              .otherwise(F.concat(asked, results)))
    found = b.explode_turns(rows.withColumn("ts", F.coalesce("j.timestamp", F.lit(""))), turns,
                            [*ORDER, "ts", "_multi"])
    return b.number_turns(found)


def event_meta(lines: DataFrame) -> DataFrame:
    """Session row: times, version, folder, model; the latest value counts."""
    rows = parse_lines(lines).select(
        "session_id", F.struct("block", "seq").alias("line_no"), F.col("j.timestamp").alias("ts"),
        F.col("j.version").alias("version"), F.col("j.cwd").alias("cwd"),
        F.when(F.col("j.type") == "assistant", F.col("j.message.model")).alias("model"))
    return session_meta(rows)


@F.pandas_udf(T.StringType())
def pretty_json(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """JSON text indented by two, for display turns."""
    def show(raw):
        if raw is None:
            return None
        try:
            return json.dumps(json.loads(raw), ensure_ascii=False, indent=2)
        except ValueError:
            return raw
    for batch in batches:
        yield batch.map(show)


def tool_heading(head: str, name, call_id, mark=None):
    short = F.when(F.coalesce(call_id, F.lit("")) != "", F.concat(
        F.lit("  (id="), F.substring(call_id, 1, 12), F.lit(")"))).otherwise("")
    return F.concat(F.lit(head), name, F.lit("") if mark is None else mark, short)


def split_blocks(rows: DataFrame, items, plain, role) -> DataFrame:
    """One turn per content block; ``items`` block texts, ``plain`` string content."""
    bs = b.blocks(items)

    def show(x):
        f = x["f"]
        text = F.coalesce(f["text"], F.lit(""))
        thought = F.coalesce(f["thinking"], F.lit(""))
        mark = F.when(F.coalesce(f["is_error"], F.lit("false")).isin("false", "0", "", "null"), "").otherwise(ERROR_MARK)
        return (F.when(f["type"] == "text", F.when(tx.strip(text) != "", F.struct(role.alias("role"), text.alias("head"), F.lit(None).cast("string").alias("input"))))
                 .when(f["type"] == "thinking", F.when(tx.strip(thought) != "", F.struct(
                     role.alias("role"), F.concat(F.lit(THINKING_PREFIX), thought).alias("head"), F.lit(None).cast("string").alias("input"))))
                 .when(f["type"] == "tool_use", F.struct(
                     role.alias("role"), tool_heading(CALL_HEAD, F.coalesce(f["name"], F.lit("?")), f["id"]).alias("head"),
                     F.coalesce(f["input"], F.lit("null")).alias("input")))
                 .when(f["type"] == "tool_result", F.struct(
                     F.lit("tool").alias("role"), F.concat(
                         tool_heading(RESULT_HEAD, F.lit(""), f["tool_use_id"], mark), F.lit("\n\n"),
                         F.when(x["kind"] == "", "null").otherwise(b.result_text(x, images=True))).alias("head"),
                     F.lit(None).cast("string").alias("input")))
                 .when(f["type"] == "image", F.struct(role.alias("role"), F.lit(IMAGE).alias("head"), F.lit(None).cast("string").alias("input")))
                 .when(F.coalesce(f["type"], F.lit("")) != "", F.struct(
                     role.alias("role"), F.concat(F.lit("["), f["type"], F.lit("]")).alias("head"), F.lit(None).cast("string").alias("input"))))

    shown = F.filter(F.transform(F.filter(bs, b.is_dict), show), lambda t: t.isNotNull())
    whole = F.when(~tx.is_blank(plain), F.array(F.struct(
        role.alias("role"), plain.alias("head"), F.lit(None).cast("string").alias("input"))))
    each = rows.select("session_id", "block", "seq", "ts", "_multi", F.posexplode(
        F.when(items.isNull(), whole).otherwise(shown)).alias("sub", "_b"))
    body = F.when(F.col("_b.input").isNull(), F.col("_b.head")).otherwise(F.concat(
        F.col("_b.head"), F.lit("\n\n```json\n"), pretty_json(F.col("_b.input")), F.lit("\n```")))
    return each.select("session_id", "block", "seq", "sub", "ts", "_multi", F.col("_b.role").alias("role"),
                       body.alias("content"), b.no_calls().alias("tool_calls"),
                       F.lit("").alias("tool_result_for"))


def event_blocks(lines: DataFrame) -> DataFrame:
    """Raw lines -> one turn per block; meta rows and other roles are dropped."""
    rows = parse_lines(lines)
    has_msg = F.col("j.message").isNotNull()
    role = F.coalesce(F.nullif(F.when(has_msg, F.col("j.message.role")).otherwise(F.col("j.role")), F.lit("")), "j.type")
    rows = rows.withColumn("role", role).withColumn("ts", F.coalesce("j.timestamp", F.lit(""))).filter(
        F.col("role").isin(*ROLES) & (F.col("j.type").isNull() | ~F.col("j.type").isin(*META_TYPES)))
    items = F.coalesce("j.message.content", "j.content")
    plain = F.when(items.isNull(), F.coalesce(F.get_json_object("raw", "$.message.content"),
                                              F.get_json_object("raw", "$.content")))
    return b.number_turns(split_blocks(rows, items, plain, F.col("role")))


def read_event_jsonl(spark: SparkSession, path: str, **options) -> DataFrame:
    return event_turns(b.read_lines(spark, path, "*.jsonl", **options))


def read_event_blocks(spark: SparkSession, path: str, **options) -> DataFrame:
    return event_blocks(b.read_lines(spark, path, "*.jsonl", **options))
