"""Rollout JSONL: ``{type, payload}`` lines and legacy ``{role, content}`` lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions import text as tx
from tracelake.operators.filters import session_meta
from tracelake.schema import ROLES, THINKING_PREFIX
from tracelake.sources import base as b

PAYLOAD = ("type:string,role:string,content:array<struct<type:string,text:string>>,summary:array<string>,"
           "name:string,arguments:string,call_id:string,output:string,model:string,cwd:string")
LINE = ("timestamp string, ended_at string, type string, role string, "
        f"content array<struct<type:string,text:string>>, payload struct<{PAYLOAD}>")
TEXT_TYPES = ("text", "input_text", "output_text")


def _role(c: Column) -> Column:
    return F.when(c == "developer", "system").otherwise(c)


def _texts(items: Column, drop_blank: bool) -> Column:
    parts = F.transform(F.filter(items, lambda x: x["type"].isin(*TEXT_TYPES)),
                        lambda x: F.coalesce(x["text"], F.lit("")))
    return b.join_text(parts, keep_blank=not drop_blank)


def _arguments(raw: Column) -> Column:
    """Arguments text parsed as JSON where it is JSON, else kept as a JSON string."""
    return F.when(F.try_parse_json(raw).isNotNull(), F.get_json_object(raw, "$")).otherwise(
        b.quote_json(F.coalesce(raw, F.lit(""))))


def _output(raw: Column) -> Column:
    """Display text of a call's output: its ``output`` or ``content`` member where it has one."""
    out, content = F.get_json_object(raw, "$.output"), F.get_json_object(raw, "$.content")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(raw), "$.output", "variant"))
    kind_c = F.schema_of_variant(F.try_variant_get(F.try_parse_json(raw), "$.content", "variant"))
    wrapped = (F.when(out.isNotNull(), F.when(kind == "STRING", out).otherwise(b.dump(out)))
                .when(content.isNotNull(), F.when(kind_c == "STRING", content).otherwise(b.dump(content))))
    return F.coalesce(F.when(F.startswith(tx.lstrip(raw), F.lit("{")), wrapped), raw, F.lit(""))


def rollout_turns(lines: DataFrame) -> DataFrame:
    rows = b.with_multi(lines).withColumn("j", F.from_json("raw", LINE, b.JSON)).filter("j IS NOT NULL")
    p = F.col("j.payload")
    legacy = F.col("j.role").isNotNull() & F.get_json_object("raw", "$.content").isNotNull()
    old_role = _role(F.col("j.role"))
    old_text = F.coalesce(_texts_or_none(F.col("j.content")), F.get_json_object("raw", "$.content"))
    old = b.one_if(old_role.isin(*ROLES) & ~tx.is_blank(old_text), b.turn(old_role, old_text))

    role = _role(p["role"])
    merged = F.when(p["content"].isNull(), F.get_json_object("raw", "$.payload.content")).otherwise(
        _texts(p["content"], True))
    message = b.one_if(role.isin(*ROLES) & ~tx.is_blank(merged), b.turn(role, merged))

    notes = F.filter(F.transform(F.coalesce(p["summary"], F.array().cast("array<string>")), lambda s: F.when(
        F.startswith(s, F.lit("{")), F.get_json_object(s, "$.text")).otherwise(s)),
        lambda s: ~tx.is_blank(s))
    inline = F.when(p["content"].isNull(), F.get_json_object("raw", "$.payload.content"))
    notes = F.concat(notes, F.when(~tx.is_blank(inline), F.array(inline)).otherwise(F.array().cast("array<string>")))
    thought = b.one_if(F.size(notes) > 0, b.turn("assistant", F.concat(
        F.lit(THINKING_PREFIX), F.array_join(notes, "\n\n"))))

    call = F.array(b.turn("assistant", F.lit(""), F.array(b.call_struct(
        p["call_id"], F.coalesce(p["name"], F.lit("tool")), _arguments(p["arguments"])))))
    result = F.array(b.turn("tool", _output(p["output"]), None, p["call_id"]))
    kind = p["type"]
    turns = (F.when(legacy, old).when(F.col("j.type") != "response_item", b.no_turns())
              .when(kind == "message", message).when(kind == "reasoning", thought)
              .when(kind == "function_call", call).when(kind == "function_call_output", result)
              .otherwise(b.no_turns()))
    ts = F.coalesce(F.nullif(F.col("j.timestamp"), F.lit("")), "j.ended_at", F.lit(""))
    found = b.explode_turns(rows.withColumn("ts", ts), turns, ["session_id", "block", "seq", "ts", "_multi"])
    return b.number_turns(found)


def _texts_or_none(items: Column) -> Column:
    return F.when(items.isNotNull(), _texts(items, False))


def rollout_meta(lines: DataFrame) -> DataFrame:
    """Session row: model and folder from the first metadata line that has them."""
    j = F.from_json("raw", LINE, b.JSON)
    meta = F.col("j.type") == "session_meta"
    rows = lines.select("session_id", "block", "seq", j.alias("j")).filter("j IS NOT NULL").select(
        "session_id", F.struct("block", "seq").alias("line_no"),
        F.coalesce(F.nullif(F.col("j.timestamp"), F.lit("")), "j.ended_at", F.lit("")).alias("ts"),
        F.lit("").alias("version"), F.when(meta, F.col("j.payload.cwd")).alias("cwd"),
        F.when(meta, F.col("j.payload.model")).alias("model"))
    return session_meta(rows, newest=False)


def read_rollout_jsonl(spark: SparkSession, path: str, **options) -> DataFrame:
    return rollout_turns(b.read_lines(spark, path, "*.json*", **options))
