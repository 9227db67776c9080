"""Role JSONL, JSON bundles, history items, enriched JSONL, markdown chats, generic documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions import text as tx
from tracelake.sources import base as b

# --- role JSONL ---------------------------------------------------------------------------

ROLE_LINE = ("role string, type string, content array<string>, ts string, timestamp string, "
             "model string, source_model string")


def _kind(json: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(json), path, "variant"))


def scalar_content(json: Column, path: str = "$.content") -> Column:
    """String content as is, absent content blank, other JSON printed."""
    kind, value = _kind(json, path), F.get_json_object(json, path)
    return F.when(kind == "STRING", value).when(
        kind.isNull() | F.startswith(kind, F.lit("ARRAY")), "").when(
        kind == "VOID", "null").otherwise(b.dump(value))


def role_turns(lines: DataFrame) -> DataFrame:
    rows = b.with_multi(lines).withColumn("j", F.from_json("raw", ROLE_LINE, b.JSON)).filter(
        F.startswith(tx.lstrip(F.col("raw")), F.lit("{")) & F.try_parse_json("raw").isNotNull())
    rows = rows.withColumn("bs", b.blocks(F.col("j.content")))
    bs = F.filter("bs", b.is_dict)
    parts = F.filter(F.transform(bs, lambda x: F.when(x["f"]["type"] == "text", x["f"]["text"]).when(
        x["f"]["type"] == "tool_result", b.result_text(x))), lambda t: F.coalesce(t, F.lit("")) != "")
    content = F.when(F.col("j.content").isNull(), scalar_content(F.col("raw"))).otherwise(F.array_join(parts, "\n"))
    calls = F.transform(b.of_type(F.col("bs"), "tool_use"), lambda x: b.call_struct(x["f"]["id"], x["f"]["name"], x["f"]["input"]))
    last = F.try_element_at(b.of_type(F.col("bs"), "tool_result"), F.lit(-1))["f"]["tool_use_id"]
    role = F.coalesce(F.nullif(F.col("j.role"), F.lit("")), F.nullif(F.col("j.type"), F.lit("")), F.lit("user"))
    rows = rows.withColumn("content", content).withColumn("ts", F.coalesce("j.ts", "j.timestamp", F.lit("")))
    turns = b.one_if(~tx.is_blank(F.col("content")) | (F.size(calls) > 0),
                     b.turn(role, F.col("content"), calls, last))
    found = b.explode_turns(rows, turns, ["session_id", "block", "seq", "ts", "_multi"])
    return b.number_turns(found)


def role_model(lines: DataFrame) -> DataFrame:
    """(session_id, model): first non-empty of model or source_model."""
    j = F.from_json("raw", ROLE_LINE, b.JSON)
    m = lines.select("session_id", F.struct("block", "seq").alias("at"), j.alias("j")).withColumn(
        "m", F.coalesce(F.nullif(F.col("j.model"), F.lit("")), F.nullif(F.col("j.source_model"), F.lit(""))))
    return m.groupBy("session_id").agg(F.coalesce(
        F.expr("min_by(m, at) FILTER (WHERE m IS NOT NULL)"), F.lit("unknown")).alias("model"))


def read_role_jsonl(spark: SparkSession, path: str, **options) -> DataFrame:
    lines = b.read_lines(spark, path, "*.jsonl", **options)
    return role_turns(lines.filter(~F.startswith(F.substring_index("path", "/", -1), F.lit("request_dump_"))))


# --- documents: one JSON object per file ---------------------------------------------------

def _doc_turns(docs: DataFrame, items: Column, build) -> DataFrame:
    """Message texts of every document -> numbered turns. Elements spread over tasks after
    the explode, ordered by their place in the document."""
    each = docs.select("session_id", (F.size(items) > 65_536).alias("_multi"), F.posexplode(items).alias("seq", "m"))
    found = build(each.withColumn("block", F.floor(F.col("seq") / 65_536)))
    return b.number_turns(found)


MESSAGE = "role string, content array<struct<type:string,text:string>>, model string"


def _plain_turns(each: DataFrame, any_type: bool, default_role: str = "user",
                 keep_blank: bool = False) -> DataFrame:
    j = F.from_json("m", MESSAGE, b.JSON)
    rows = each.filter(F.startswith("m", F.lit("{"))).withColumn("j", j)
    parts = F.filter(F.col("j.content"), lambda x: x.isNotNull() & (F.lit(any_type) | (x["type"] == "text")))
    text = b.join_text(F.transform(parts, lambda x: F.coalesce(x["text"], F.lit(""))), keep_blank=True)
    content = F.when(F.col("j.content").isNull(), scalar_content(F.col("m"))).otherwise(text)
    rows = rows.withColumn("content", content).withColumn(
        "role", F.coalesce(F.nullif(F.col("j.role"), F.lit("")), F.lit(default_role)))
    if not keep_blank:
        rows = rows.filter(~tx.is_blank(F.col("content")))
    return rows.select("session_id", "block", "seq", "_multi", F.lit(0).alias("sub"), "role", "content",
                       F.lit("").alias("ts"), b.no_calls().alias("tool_calls"), F.lit("").alias("tool_result_for"))


BUNDLE = ("session_id string, timestamp string, model string, cwd string, version string, reason string, "
          "messages array<string>, history array<string>, turns array<string>, "
          "request struct<body:struct<messages:array<string>,model:string,tools:string>>")


def _first_list(*lists: Column) -> Column:
    return F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists], F.array().cast("array<string>"))


def bundle_turns(docs: DataFrame) -> DataFrame:
    """One object per file; system messages are left to ``bundle_meta``."""
    j = docs.withColumn("j", F.from_json("raw", BUNDLE, b.JSON))
    j = j.withColumn("session_id", F.coalesce(F.nullif(F.col("j.session_id"), F.lit("")), "session_id"))
    items = _first_list(F.col("j.messages"), F.col("j.history"), F.col("j.turns"), F.col("j.request.body.messages"))
    return _doc_turns(j, items, lambda e: _plain_turns(e, False).filter("role <> 'system'"))


def bundle_meta(docs: DataFrame) -> DataFrame:
    """Session rows of bundles: model, times, tools and the system messages as JSON text."""
    j = docs.withColumn("j", F.from_json("raw", BUNDLE, b.JSON))
    items = _first_list(F.col("j.messages"), F.col("j.history"), F.col("j.turns"), F.col("j.request.body.messages"))
    system = F.filter(items, lambda m: F.get_json_object(m, "$.role") == "system")
    return j.select(
        F.coalesce(F.nullif(F.col("j.session_id"), F.lit("")), "session_id").alias("session_id"),
        F.coalesce("j.timestamp", F.lit("")).alias("started_at"),
        F.coalesce(F.nullif(F.col("j.model"), F.lit("")), F.nullif(F.col("j.request.body.model"), F.lit("")), F.lit("unknown")).alias("model"),
        F.coalesce("j.cwd", F.lit("")).alias("cwd"), F.coalesce("j.version", F.lit("")).alias("agent_version"),
        F.create_map(F.lit("system"), F.to_json(F.transform(system, lambda m: F.get_json_object(m, "$.content"))),
                     F.lit("tools"), F.coalesce("j.request.body.tools", F.lit("[]")),
                     F.lit("reason"), F.coalesce("j.reason", F.lit(""))).alias("extra"))


def read_json_bundle(spark: SparkSession, path: str, **options) -> DataFrame:
    return bundle_turns(b.read_docs(spark, path, "*.json", **options))


HISTORY = "model string, history array<string>, messages array<string>"


def history_turns(docs: DataFrame) -> DataFrame:
    """``{history: [{message: {role, content}}]}``; plain items count as messages."""
    j = docs.withColumn("j", F.from_json("raw", HISTORY, b.JSON))
    items = F.transform(_first_list(F.col("j.history"), F.col("j.messages")),
                        lambda m: F.coalesce(F.get_json_object(m, "$.message"), m))
    return _doc_turns(j, items, lambda e: _plain_turns(e, True))


def read_history_items(spark: SparkSession, path: str, **options) -> DataFrame:
    return history_turns(b.read_docs(spark, path, "*.json", **options))


def markdown_turns(docs: DataFrame) -> DataFrame:
    """``#### request`` headings, the text below each is the answer; the preamble is skipped."""
    chunks = F.split("raw", r"(?md)^####\s+")
    each = docs.select("session_id", (F.size(chunks) > 65_536).alias("_multi"), F.posexplode(F.slice(chunks, F.lit(2), F.greatest(F.size(chunks) - 1, F.lit(0)))).alias("seq", "c"))
    cut = F.locate("\n", F.col("c"))
    head = tx.strip(F.when(cut > 0, F.substring("c", F.lit(1), cut - 1)).otherwise(F.col("c")))
    rest = tx.strip(F.when(cut > 0, F.substring(F.col("c"), cut + 1, F.length("c"))).otherwise(F.lit("")))
    turns = F.concat(b.one_if(head != "", b.turn("user", head)), b.one_if(rest != "", b.turn("assistant", rest)))
    rows = each.withColumn("block", F.floor(F.col("seq") / 65_536)).withColumn("ts", F.lit(""))
    return b.number_turns(b.explode_turns(rows, turns, ["session_id", "block", "seq", "ts", "_multi"]))


def read_markdown_chat(spark: SparkSession, path: str, **options) -> DataFrame:
    docs = b.read_docs(spark, path, "*.md", **options)
    # the folder names the session
    return markdown_turns(docs.withColumn("session_id", F.element_at(F.split("path", "/"), -2)))


ENRICHED = ("session_id string, composer_id string, id string, messages array<string>, trajectory array<string>, "
            "model string, cwd string, started_at string, ended_at string, cursor_version string, mode string")


def enriched_turns(lines: DataFrame, ident: str | None = None) -> DataFrame:
    """One session per line; ``ident`` is a case-insensitive id prefix."""
    j = lines.withColumn("j", F.from_json("raw", ENRICHED, b.JSON)).filter("j IS NOT NULL")
    sid = F.coalesce(*[F.nullif(F.col(f"j.{c}"), F.lit("")) for c in ("session_id", "composer_id", "id")], F.lit(""))
    j = j.withColumn("session_id", sid)
    if ident is not None and ident.lower() != "latest":
        j = j.filter(F.startswith(F.lower("session_id"), F.lit(ident.lower())))
    items = _first_list(F.col("j.messages"), F.col("j.trajectory"))
    return _doc_turns(j, items, lambda e: _plain_turns(e, False, keep_blank=True))


def read_enriched_jsonl(spark: SparkSession, path: str, ident: str | None = None, **options) -> DataFrame:
    return enriched_turns(b.read_lines(spark, path, "*.jsonl", **options), ident)


# --- generic -------------------------------------------------------------------------------

GENERIC = ("name string, role string, type string, content array<string>, text string, message string, "
           "tool_call_id string, tool_use_id string, timestamp string, ts string, created_at string, "
           "tool_calls array<struct<id:string,name:string,arguments:string,function:struct<name:string,arguments:string>>>")


def normalize_messages(each: DataFrame) -> DataFrame:
    """Message texts (session_id, block, seq, m) -> unnumbered turns; blank ones are dropped."""
    rows = b.with_multi(each).filter(F.startswith(tx.lstrip(F.col("m")), F.lit("{"))).withColumn(
        "j", F.from_json("m", GENERIC, b.JSON)).filter("j IS NOT NULL")
    rows = rows.withColumn("bs", b.blocks(F.col("j.content")))
    bs = F.col("bs")
    kind = lambda x: F.coalesce(x["f"]["type"], F.lit("text"))
    parts = F.filter(F.transform(bs, lambda x: (
        F.when(~b.is_dict(x), x["raw"]).when(kind(x) == "text", x["f"]["text"])
         .when(kind(x).isin("tool_use", "function_call"), "")
         .when(kind(x) == "tool_result", b.result_text(x)).otherwise(b.dump(x["raw"])))),
        lambda t: F.coalesce(t, F.lit("")) != "")
    absent = F.get_json_object("m", "$.content").isNull()
    scalar = F.when(absent, F.when(_kind(F.col("m"), "$.text").isNotNull(), scalar_content(F.col("m"), "$.text"))
                    .otherwise(scalar_content(F.col("m"), "$.message"))).otherwise(scalar_content(F.col("m")))
    content = F.when(F.col("j.content").isNull(), scalar).otherwise(F.array_join(parts, "\n"))
    block_calls = F.transform(F.filter(bs, lambda x: b.is_dict(x) & kind(x).isin("tool_use", "function_call")),
                              lambda x: b.call_struct(x["f"]["id"], x["f"]["name"], F.coalesce(x["f"]["input"], x["f"]["arguments"])))
    api_calls = F.transform(F.coalesce(F.col("j.tool_calls"), F.array().cast(
        "array<struct<id:string,name:string,arguments:string,function:struct<name:string,arguments:string>>>")),
        lambda c: b.call_struct(c["id"], F.coalesce(c["function"]["name"], c["name"]),
                                F.coalesce(c["function"]["arguments"], c["arguments"])))
    last = F.try_element_at(b.of_type(bs, "tool_result"), F.lit(-1))["f"]["tool_use_id"]
    result_for = F.coalesce(last, F.nullif(F.col("j.tool_call_id"), F.lit("")), "j.tool_use_id", F.lit(""))
    rows = rows.select(
        "session_id", "block", "seq", "_multi", F.lit(0).alias("sub"),
        tx.coerce_role(F.coalesce("j.role", "j.type"), F.col("j.name")).alias("role"), content.alias("content"),
        F.coalesce("j.timestamp", "j.ts", "j.created_at", F.lit("")).alias("ts"),
        F.concat(block_calls, api_calls).alias("tool_calls"), result_for.alias("tool_result_for"))
    return rows.filter(~tx.is_blank(F.col("content")) | (F.size("tool_calls") > 0))


LIST_KEYS = ("trajectory", "messages", "turns", "history", "conversation", "chat_history", "events")
SHAPE = (", ".join(f"{k} array<string>" for k in LIST_KEYS)
         + ", request struct<body:struct<messages:array<string>>>"
         + ", runs array<struct<inputs:struct<messages:array<string>>,outputs:string>>")


def detect_shape(docs: DataFrame) -> DataFrame:
    """Documents with ``shape`` and ``items`` (message texts), first match wins: JSON lines,
    bare list, list under a known key, request body, runs, single message, plain text."""
    j = docs.withColumn("j", F.from_json("raw", SHAPE, b.JSON)).withColumn(
        "kind", F.schema_of_variant(F.try_parse_json("raw")))
    lines = F.filter(F.transform(F.split("raw", "\n"), tx.strip), lambda x: x != "")
    bad = F.exists(lines, lambda x: ~F.startswith(x, F.lit("{")) | F.try_parse_json(x).isNull())
    jsonl = (F.size(lines) > 1) & ~bad
    out_msg = lambda o: F.concat(
        F.lit('{"role":"assistant","content":'), b.quote_json(b.dump(o)), F.lit("}"))
    runs = F.flatten(F.transform(F.coalesce(F.col("j.runs"), F.array().cast(
        "array<struct<inputs:struct<messages:array<string>>,outputs:string>>")), lambda r: F.concat(
            F.coalesce(r["inputs"]["messages"], F.array().cast("array<string>")),
            F.when(F.startswith(r["outputs"], F.lit("{")), F.array(out_msg(r["outputs"]))).otherwise(
                F.array().cast("array<string>")))))
    single = F.get_json_object("raw", "$.role").isNotNull() | F.get_json_object("raw", "$.content").isNotNull()
    text_turn = F.array(F.concat(F.lit('{"role":"user","content":'), b.quote_json(tx.strip(F.col("raw"))), F.lit("}")))
    is_object = F.startswith("kind", F.lit("OBJECT"))
    body = F.col("j.request.body.messages")
    shape, items = F.when(jsonl, "jsonl"), F.when(jsonl, lines)
    shape = shape.when(F.col("kind").isNull(), "text")
    items = items.when(F.col("kind").isNull(), text_turn)
    shape = shape.when(F.startswith("kind", F.lit("ARRAY")), "list")
    items = items.when(F.startswith("kind", F.lit("ARRAY")), F.from_json("raw", "array<string>", b.JSON))
    for k in LIST_KEYS:
        hit = is_object & (F.size(F.col(f"j.{k}")) > 0)
        shape, items = shape.when(hit, k), items.when(hit, F.col(f"j.{k}"))
    for name, hit, found in (("request", is_object & body.isNotNull() & (F.size(body) > 0), body),
                             ("runs", is_object & (F.size(runs) > 0), runs),
                             ("message", is_object & single, F.array("raw"))):
        shape, items = shape.when(hit, name), items.when(hit, found)
    return j.withColumn("shape", shape.otherwise("none")).withColumn(
        "items", F.coalesce(items, F.array().cast("array<string>"))).drop("j", "kind")


def generic_turns(docs: DataFrame) -> DataFrame:
    shaped = detect_shape(docs)
    sid = F.when(F.col("shape") == "jsonl", F.col("session_id")).otherwise(
        F.coalesce(F.get_json_object("raw", "$.session_id"), F.col("session_id")))
    shaped = shaped.withColumn("session_id", F.when(F.col("shape").isin(*LIST_KEYS, "request", "runs"), sid).otherwise(F.col("session_id")))
    return _doc_turns(shaped, F.col("items"), normalize_messages)


def read_any_chat(spark: SparkSession, path: str, **options) -> DataFrame:
    """Any chat file. Files whose lines are all JSON objects are read as lines, however large;
    only the rest is read as whole documents."""
    lines = b.read_lines(spark, path, **options).filter(~tx.is_blank(F.col("raw")))
    text = tx.strip(F.col("raw"))
    is_obj = F.startswith(text, F.lit("{")) & F.try_parse_json(text).isNotNull()
    jsonl = (lines.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.count_if(~is_obj).alias("bad"))
             .filter("n > 1 AND bad = 0").select("path"))
    rows = lines.join(jsonl, "path", "left_semi").withColumn("m", text)
    by_line = b.number_turns(normalize_messages(rows))
    docs = b.read_docs(spark, path, **options).join(jsonl, "path", "left_anti")
    return by_line.unionByName(generic_turns(docs))
