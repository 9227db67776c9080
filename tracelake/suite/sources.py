"""Readers over raw records that Spark renders from the given conversations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions import text as tx
from tracelake.schema import THINKING_PREFIX
from tracelake.session import many_folders, shared_dir, write_folders
from tracelake.sources import base, chat, event_log, listing, messages, rollout
from tracelake.sources.registry import read_traces, register_reader
from tracelake.suite.cards import CARD_SQL, CLEAN_SQL, FINGERPRINT_CTE, REAL_ASSISTANT, flat_sql, strip_sql
from tracelake.suite.registry import case, spread, table, turns

TEXT = "struct<type:string,text:string>"


def conv(spark, sf):
    return spread(table(spark, sf, "conversations")).select(
        F.concat(F.lit("s"), F.col("conv_id").cast("string")).alias("session_id"), "conv_id", "turn", "role", "text",
        F.floor(F.col("turn") / 3).alias("block"), F.col("turn").alias("seq"))


def blocks_json(*items):
    """Block array as JSON text, absent blocks left out."""
    return F.concat(F.lit("["), F.array_join(F.array_compact(F.array(*items)), ","), F.lit("]"))


def js(**fields):
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def stamp():
    return F.concat(F.lit("2024-01-01T00:00:0"), F.col("turn").cast("string"), F.lit("Z"))


def call_id():
    return F.concat(F.lit("call-"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))


def has_call():
    return (F.col("role") == "assistant") & (F.col("conv_id") % 3 == 1)


def tool_input():
    return F.concat(F.lit('{"z":'), F.col("turn").cast("string"), F.lit(',"cmd":"ls \\"x\\""}'))




def tool_use():
    return F.when(has_call(), F.concat(F.lit('{"type":"tool_use","id":"'), call_id(), F.lit('","name":"Bash","input":'), tool_input(), F.lit("}")))


def event_lines(spark, sf):
    """Assistant rows: thinking, text and call in one message; the next user row holds the
    tool result before its text; some meta rows and broken lines between."""
    c = conv(spark, sf)
    text = js(type=F.lit("text"), text=F.col("text"))
    think = F.when((F.col("role") == "assistant") & (F.col("turn") % 4 == 1), js(
        type=F.lit("thinking"), thinking=F.concat(F.lit("about "), F.col("conv_id").cast("string")), signature=F.lit("xx")))
    prev_id = F.concat(F.lit("call-"), F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") - 1).cast("string"))
    result = F.when((F.col("role") == "user") & (F.col("conv_id") % 3 == 1) & (F.col("turn") > 0), F.concat(
        F.lit('{"type":"tool_result","tool_use_id":"'), prev_id, F.lit('","content":'),
        F.when(F.col("turn") % 4 == 0, F.lit('[{"type":"text","text":"ok"},{"type":"image"},{"type":"text","text":"done"}]'))
        .otherwise(F.lit('"[plain]"')), F.lit("}")))
    as_text = (F.col("role") == "user") & (F.col("conv_id") % 3 == 0)
    content = F.when(as_text, base.quote_json(F.col("text"))).otherwise(blocks_json(text, result, tool_use(), think))
    msg = F.concat(F.lit('{"role":"'), "role", F.lit('","model":"m'), (F.col("conv_id") % 2).cast("string"), F.lit('","content":'), content, F.lit("}"))
    line = F.concat(F.lit('{"type":"'), "role", F.lit('","timestamp":"'), stamp(), F.lit('","version":"1.'), F.col("turn").cast("string"),
                    F.lit('","cwd":"/w/'), (F.col("conv_id") % 5).cast("string"), F.lit('","message":'), msg, F.lit("}"))
    meta = F.lit('{"type":"summary","summary":"x"}')
    return (c.withColumn("raw", F.explode(F.array(line, meta, F.lit("{broken"))))
            .withColumn("seq", F.col("seq") * 10 + F.when(F.col("raw") == meta, 1).otherwise(0))
            .withColumn("mtime", F.timestamp_seconds(F.col("conv_id"))).withColumn("size_bytes", F.lit(50_000_000) + F.col("conv_id") * 10)
            .select("session_id", "block", "seq", "raw", "mtime", "size_bytes"))


RAW_CTE = """c AS (SELECT 's' || conv_id AS session_id, conv_id, turn, role, text, '2024-01-01T00:00:0' || turn || 'Z' AS ts, 'call-' || conv_id || '-' || turn AS call_id,
  role = 'assistant' AND conv_id % 3 = 1 AS has_call FROM conversations),
ev AS (
  SELECT session_id, turn, 0 AS sub, role, '{think}about ' || conv_id AS content, ts, '' AS call, '' AS result_for FROM c WHERE role = 'assistant' AND turn % 4 = 1
  UNION ALL SELECT session_id, turn, 1, role, text, ts, CASE WHEN has_call THEN call_id ELSE '' END, '' FROM c WHERE role IN ('user', 'assistant')
  UNION ALL SELECT session_id, turn, 2, 'tool', CASE WHEN turn % 4 = 0 THEN 'ok' || chr(10) || 'done' ELSE '[plain]' END, ts, '', 'call-' || conv_id || '-' || (turn - 1)
    FROM c WHERE role = 'user' AND conv_id % 3 = 1 AND turn > 0)""".replace("{think}", THINKING_PREFIX)
NUMBERED = "SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY turn, sub) - 1 AS turn_index, role, content, ts, call, result_for FROM ev"


def flat_calls(df, *more):
    return df.select("session_id", "turn_index", "role", "content", "ts",
                     F.coalesce(F.get("tool_calls", F.lit(0))["id"], F.lit("")).alias("call"),
                     F.col("tool_result_for").alias("result_for"), *more)


@case("read_event_jsonl", f"WITH {RAW_CTE} {NUMBERED}")
def read_event_jsonl(spark, sf):
    return flat_calls(event_log.event_turns(event_lines(spark, sf)))


@case("event_tool_inputs", f"""WITH {RAW_CTE} SELECT session_id, call_id, 'Bash' AS name, '{{"z":' || turn || ',"cmd":"ls \\"x\\""}}' AS input FROM c WHERE has_call""")
def event_tool_inputs(spark, sf):
    t = event_log.event_turns(event_lines(spark, sf))
    return t.select("session_id", F.explode("tool_calls").alias("c")).select(
        "session_id", F.col("c.id").alias("call_id"), "c.name", "c.input")


@case("event_session_meta", """SELECT 's' || conv_id AS session_id, '2024-01-01T00:00:0' || min(turn) || 'Z' AS started_at, '2024-01-01T00:00:0' || max(turn) || 'Z' AS ended_at,
  '1.' || max(turn) AS agent_version, '/w/' || (conv_id % 5) AS cwd, CASE WHEN bool_or(role = 'assistant') THEN 'm' || (conv_id % 2) ELSE 'unknown' END AS model FROM conversations GROUP BY conv_id""")
def event_session_meta(spark, sf):
    return event_log.event_meta(event_lines(spark, sf))


SPLIT_CTE = RAW_CTE.split(",\nev AS")[0] + f""",
ev AS (SELECT session_id, turn, 0 AS sub, role, text AS content, ts FROM c
  UNION ALL SELECT session_id, turn, 1, 'tool', '📤 工具返回  (id=' || substring('call-' || conv_id || '-' || (turn - 1), 1, 12) || ')' || chr(10) || chr(10) ||
    CASE WHEN turn % 4 = 0 THEN 'ok' || chr(10) || '[image]' || chr(10) || 'done' ELSE '[plain]' END, ts FROM c WHERE role = 'user' AND conv_id % 3 = 1 AND turn > 0
  UNION ALL SELECT session_id, turn, 2, role, '🔧 调用工具: Bash  (id=' || substring(call_id, 1, 12) || ')' || chr(10) || chr(10) || '```json' || chr(10) || '{{' || chr(10)
    || '  "z": ' || turn || ',' || chr(10) || '  "cmd": "ls \\"x\\""' || chr(10) || '}}' || chr(10) || '```', ts FROM c WHERE has_call
  UNION ALL SELECT session_id, turn, 3, role, '{THINKING_PREFIX}about ' || conv_id, ts FROM c WHERE role = 'assistant' AND turn % 4 = 1)"""


@case("read_event_blocks", f"WITH {SPLIT_CTE} SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY turn, sub) - 1 AS turn_index, role, content, ts FROM ev")
def read_event_blocks(spark, sf):
    return event_log.event_blocks(event_lines(spark, sf)).select("session_id", "turn_index", "role", "content", "ts")


def rollout_lines(spark, sf):
    c = conv(spark, sf)
    text = js(type=F.when(F.col("role") == "assistant", "output_text").otherwise("input_text"), text=F.col("text"))
    role = F.when(F.col("role") == "system", "developer").otherwise(F.col("role"))
    head = F.concat(F.lit('{"timestamp":"'), stamp(), F.lit('","type":"'))
    message = F.when(F.col("conv_id") % 4 == 2, F.to_json(F.struct(F.col("role").alias("role"), F.col("text").alias("content"), stamp().alias("timestamp")))).otherwise(
        F.concat(head, F.lit('response_item","payload":{"type":"message","role":"'), role, F.lit('","content":['), text, F.lit("]}}")))
    meta = F.when(F.col("turn") < 2, F.concat(head, F.lit('session_meta","payload":{"model":"r'), F.col("turn").cast("string"), F.lit('","cwd":"/r"}}')))
    reason = F.when((F.col("role") == "assistant") & (F.col("turn") % 4 == 1), F.concat(
        head, F.lit('response_item","payload":{"type":"reasoning","summary":[{"text":"plan"},"go"],"encrypted_content":"zz"}}')))
    call = F.when(has_call(), F.concat(head, F.lit('response_item","payload":{"type":"function_call","name":"shell","arguments":'),
                                     base.quote_json(tool_input()), F.lit(',"call_id":"'), call_id(), F.lit('"}}')))
    out = F.when(has_call(), F.concat(head, F.lit('response_item","payload":{"type":"function_call_output","output":'),
                                    F.when(F.col("turn") % 4 == 1, base.quote_json(F.lit('{"output":"fine","metadata":{}}'))).otherwise(F.lit('"raw out"')),
                                    F.lit(',"call_id":"'), call_id(), F.lit('"}}')))
    dup = F.concat(head, F.lit('event_msg","payload":{"type":"agent_message","message":"x"}}'))
    return (c.select("session_id", "block", "seq", F.posexplode(F.array(meta, reason, message, dup, call, out)).alias("k", "raw"))
            .filter("raw IS NOT NULL").withColumn("seq", F.col("seq") * 10 + F.col("k")).select("session_id", "block", "seq", "raw"))


ROLLOUT_EV = f"""ev AS (SELECT session_id, turn, 0 AS sub, role, '{THINKING_PREFIX}plan' || chr(10) || chr(10) || 'go' AS content, ts, '' AS call, '' AS result_for FROM c WHERE role = 'assistant' AND turn % 4 = 1
  UNION ALL SELECT session_id, turn, 1, role, text, ts, '', '' FROM c
  UNION ALL SELECT session_id, turn, 2, role, '', ts, call_id, '' FROM c WHERE has_call
  UNION ALL SELECT session_id, turn, 3, 'tool', CASE WHEN turn % 4 = 1 THEN 'fine' ELSE 'raw out' END, ts, '', call_id FROM c WHERE has_call)"""


@case("read_rollout_jsonl", f"WITH {RAW_CTE.split(',' + chr(10) + 'ev AS')[0]}, {ROLLOUT_EV} {NUMBERED}")
def read_rollout_jsonl(spark, sf):
    return flat_calls(rollout.rollout_turns(rollout_lines(spark, sf)))


@case("rollout_session_meta", """SELECT 's' || conv_id AS session_id, '2024-01-01T00:00:0' || min(turn) || 'Z' AS started_at, '2024-01-01T00:00:0' || max(turn) || 'Z' AS ended_at,
  '' AS agent_version, '/r' AS cwd, 'r' || min(turn) AS model FROM conversations GROUP BY conv_id""")
def rollout_session_meta(spark, sf):
    return rollout.rollout_meta(rollout_lines(spark, sf))


def role_lines(spark, sf):
    c = conv(spark, sf)
    text = js(type=F.lit("text"), text=F.col("text"))
    content = F.when(F.col("conv_id") % 2 == 0, base.quote_json(F.col("text"))).otherwise(blocks_json(text, tool_use()))
    blank = F.when(F.col("turn") == 2, F.lit('{"role":"user","content":"  "}'))
    line = F.concat(F.lit('{"role":"'), "role", F.lit('","content":'), content, F.lit(',"timestamp":"'), stamp(),
                    F.lit('","source_model":"q'), (F.col("conv_id") % 2).cast("string"), F.lit('"}'))
    return (c.select("session_id", "block", "seq", F.posexplode(F.array(blank, line)).alias("k", "raw")).filter("raw IS NOT NULL")
            .withColumn("seq", F.col("seq") * 10 + F.col("k")).select("session_id", "block", "seq", "raw"))


ROLE_SQL = """SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY turn) - 1 AS turn_index, role, text AS content, ts,
  CASE WHEN has_call AND conv_id % 2 = 1 THEN call_id ELSE '' END AS call, '' AS result_for FROM c"""
C_ONLY = RAW_CTE.split(",\nev AS")[0]


@case("read_role_jsonl", f"WITH {C_ONLY} {ROLE_SQL}")
def read_role_jsonl(spark, sf):
    return flat_calls(messages.role_turns(role_lines(spark, sf)))


@case("role_model", "SELECT 's' || conv_id AS session_id, 'q' || (conv_id % 2) AS model FROM conversations GROUP BY conv_id")
def role_model(spark, sf):
    return messages.role_model(role_lines(spark, sf))


def docs(spark, sf, item, head="", tail="", sep=","):
    """One document per session around its item texts."""
    c = conv(spark, sf).withColumn("item", item).filter("item IS NOT NULL")
    d = c.groupBy("session_id", "conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "item"))).alias("l"))
    return d.select("session_id", "conv_id", F.concat(F.lit(head), F.array_join(F.transform("l", lambda x: x["item"]), sep), F.lit(tail)).alias("raw"))


def msg():
    return js(role=F.col("role"), content=F.col("text"))


BASIC = ["session_id", "turn_index", "role", "content"]


def basic_sql(where="TRUE", sid="session_id"):
    return (f"WITH {C_ONLY} SELECT {sid} AS session_id, row_number() OVER (PARTITION BY session_id ORDER BY turn) - 1 AS turn_index, "
            f"role, text AS content FROM c WHERE {where}")


@case("read_json_bundle", basic_sql("role <> 'system'", "'b-' || session_id"))
def read_json_bundle(spark, sf):
    d = docs(spark, sf, msg())
    raw = F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit('{"session_id":"b-'), "session_id", F.lit('","messages":['), "raw", F.lit('],"model":"x"}'))).otherwise(
        F.concat(F.lit('{"session_id":"b-'), "session_id", F.lit('","request":{"body":{"messages":['), "raw", F.lit('],"model":"y","tools":[{"n":1}]}}}')))
    return messages.bundle_turns(d.withColumn("raw", raw)).select(*BASIC)


@case("json_bundle_meta", "SELECT 's' || conv_id AS session_id, CASE WHEN conv_id % 2 = 0 THEN 'x' ELSE 'y' END AS model, count(*) FILTER (role = 'system') AS n_system FROM conversations GROUP BY conv_id")
def json_bundle_meta(spark, sf):
    d = docs(spark, sf, msg())
    raw = F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit('{"messages":['), "raw", F.lit('],"model":"x"}'))).otherwise(
        F.concat(F.lit('{"request":{"body":{"messages":['), "raw", F.lit('],"model":"y"}}}')))
    return messages.bundle_meta(d.withColumn("raw", raw)).select("session_id", "model", F.size(F.from_json(
        F.col("extra")["system"], "array<string>")).cast("long").alias("n_system"))


@case("read_history_items", basic_sql())
def read_history_items(spark, sf):
    item = F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit('{"message":'), msg(), F.lit(',"contextItems":[]}'))).otherwise(msg())
    return messages.history_turns(docs(spark, sf, item, '{"history":[', ']}')).select(*BASIC)


MD_TEXT = flat_sql("text")


@case("read_markdown_chat", f"WITH {C_ONLY} SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY turn) - 1 AS turn_index, role, {MD_TEXT} AS content FROM c WHERE role IN ('user', 'assistant')")
def read_markdown_chat(spark, sf):
    flat = tx.flatten_ws(F.col("text"))
    item = F.when(F.col("role") == "user", F.concat(F.lit("#### "), flat)).when(F.col("role") == "assistant", F.concat(F.lit("\n"), flat, F.lit("\n")))
    return messages.markdown_turns(docs(spark, sf, item, "# log\n\n", "\n", "\n")).select(*BASIC)


@case("read_enriched_jsonl", basic_sql("TRUE", "'E-' || session_id"))
def read_enriched_jsonl(spark, sf):
    d = docs(spark, sf, msg())
    key = F.when(F.col("conv_id") % 3 == 0, "session_id").when(F.col("conv_id") % 3 == 1, "composer_id").otherwise("id")
    where = F.when(F.col("conv_id") % 2 == 0, "messages").otherwise("trajectory")
    raw = F.concat(F.lit('{"'), key, F.lit('":"E-'), "session_id", F.lit('","'), where, F.lit('":['), "raw", F.lit("]}"))
    return messages.enriched_turns(d.withColumn("raw", raw), "e-s").select(*BASIC)


def any_docs(spark, sf):
    """Every conversation as one document of its own texts, in six shapes."""
    d = docs(spark, sf, msg())
    n = F.col("conv_id") % 6
    lines = docs(spark, sf, msg(), sep="\n").select("session_id", F.col("raw").alias("jl"))
    plain = docs(spark, sf, F.col("text"), "Notes: ", sep="\n\n").select("session_id", F.col("raw").alias("plain"))
    d = d.join(lines, "session_id").join(plain, "session_id")
    raw = (F.when(n == 0, F.col("jl")).when(n == 1, F.concat(F.lit("["), "raw", F.lit("]")))
            .when(n == 2, F.concat(F.lit('{"conversation":['), "raw", F.lit("]}")))
            .when(n == 3, F.concat(F.lit('{"request":{"body":{"messages":['), "raw", F.lit("]}}}")))
            .when(n == 4, F.concat(F.lit('{"runs":[{"inputs":{"messages":['), "raw", F.lit(']},"outputs":{"answer":1}}]}')))
            .otherwise(F.col("plain")))
    return d.select("session_id", "conv_id", raw.alias("raw"))


@case("detect_shape", "SELECT 's' || conv_id AS session_id, CASE conv_id % 6 WHEN 0 THEN CASE WHEN count(*) > 1 THEN 'jsonl' ELSE 'message' END WHEN 1 THEN 'list' WHEN 2 THEN 'conversation' WHEN 3 THEN 'request' WHEN 4 THEN 'runs' ELSE 'text' END AS shape, "
      "count(*) * CAST(conv_id % 6 < 5 AS INT) + CAST(conv_id % 6 >= 4 AS INT) AS n_items FROM conversations GROUP BY conv_id")
def detect_shape(spark, sf):
    return messages.detect_shape(any_docs(spark, sf)).select("session_id", "shape", F.size("items").cast("long").alias("n_items"))


@case("read_any_chat", f"""WITH {C_ONLY}, ev AS (SELECT session_id, turn, role, text AS content FROM c WHERE conv_id % 6 < 5
  UNION ALL SELECT DISTINCT session_id, 1000, 'assistant', '{{"answer": 1}}' FROM c WHERE conv_id % 6 = 4
  UNION ALL SELECT session_id, 0, 'user', {strip_sql("'Notes: ' || string_agg(text, chr(10) || chr(10) ORDER BY turn)")} FROM c WHERE conv_id % 6 = 5 GROUP BY session_id)
 SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY turn) - 1 AS turn_index, role, content FROM ev""")
def read_any_chat(spark, sf):
    """Files of all shapes in one folder, through the reader; the folder of a file names its session."""
    inbox = shared_dir(spark, "chats")
    write_folders(any_docs(spark, sf).select("session_id", F.col("raw").alias("value")), inbox, "session_id")
    with many_folders(spark):
        files = spark.read.option("recursiveFileLookup", "true").text(inbox, wholetext=True)
    owner = files.select(F.col("_metadata.file_path").alias("path")).select(
        base.session_key(F.col("path")).alias("file"), F.regexp_extract("path", "session_id=([^/]+)/", 1).alias("owner"))
    turns = messages.read_any_chat(spark, inbox).withColumnRenamed("session_id", "file").join(owner, "file")
    return turns.withColumnRenamed("owner", "session_id").select(*BASIC)


def odd_messages(spark, sf):
    """Messages in several dialects, each around the row's own text: group chats, block lists with bare strings,
    API calls, results as objects, texts under another key; blank ones between."""
    c = conv(spark, sf)
    n = F.col("conv_id") % 5
    quoted = base.quote_json(F.col("text"))
    m = (F.when(n == 0, F.concat(F.lit('{"name":"planner","role":"critic","text":'), quoted, F.lit(',"created_at":'), stamp_q(), F.lit("}")))
          .when(n == 1, F.concat(F.lit('{"role":"AI","content":["head",{"type":"text","text":'), quoted, F.lit('},{"type":"image","url":"u"}],"ts":'), stamp_q(), F.lit("}")))
          .when(n == 2, F.concat(F.lit('{"role":"assistant","content":null,"timestamp":'), stamp_q(), F.lit(',"tool_calls":[{"id":"k","function":{"name":"f","arguments":'),
                                 base.quote_json(F.concat(F.lit("run: "), "text")), F.lit("}}]}")))
          .when(n == 3, F.concat(F.lit('{"type":"function","content":{"b":1,"a":'), quoted, F.lit('},"tool_call_id":"k"}')))
          .otherwise(F.concat(F.lit('{"role":"human","message":'), quoted, F.lit("}"))))
    blank = c.filter(n == 4).select("session_id", "block", (2 * F.col("seq") + 1).alias("seq"), F.lit('{"role":"user","content":"  "}').alias("m"))
    return c.select("session_id", "block", (2 * F.col("seq")).alias("seq"), m.alias("m")).unionByName(blank)


def stamp_q():
    return F.concat(F.lit('"'), stamp(), F.lit('"'))


@case("normalize_message", f"""WITH {C_ONLY} SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY turn) - 1 AS turn_index,
  CASE conv_id % 5 WHEN 3 THEN 'tool' WHEN 4 THEN 'user' ELSE 'assistant' END AS role,
  CASE conv_id % 5 WHEN 1 THEN 'head' || chr(10) || text || chr(10) || '{{"type": "image", "url": "u"}}' WHEN 2 THEN ''
   WHEN 3 THEN '{{"b": 1, "a": ' || CAST(to_json(text) AS VARCHAR) || '}}' ELSE text END AS content,
  CASE WHEN conv_id % 5 >= 3 THEN '' ELSE ts END AS ts, CASE WHEN conv_id % 5 = 2 THEN 'k' ELSE '' END AS call, CASE WHEN conv_id % 5 = 3 THEN 'k' ELSE '' END AS result_for,
  CASE WHEN conv_id % 5 = 2 THEN 'run: ' || text ELSE '' END AS call_input FROM c""")
def normalize_message(spark, sf):
    turns = base.number_turns(messages.normalize_messages(odd_messages(spark, sf)))
    return flat_calls(turns, F.coalesce(F.get("tool_calls", F.lit(0))["input"], F.lit("")).alias("call_input"))


@case("content_text", "SELECT conv_id, turn, text || chr(10) || 'end' AS content FROM conversations")
def content_text(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", base.join_text(F.array("text", F.lit("  "), F.lit("end"))).alias("content"))


CHAT = """SELECT doc.event_id AS id, concat('agent', CAST(user_id % 7 AS STRING)) AS s0, CASE WHEN user_id % 9 = 0 THEN 'human' ELSE concat('agent', CAST(user_id % 7 AS STRING)) END AS sender,
  concat('agent', CAST(event_id % 5 AS STRING)) AS recipient, props AS content, CASE WHEN event_id % 3 = 0 THEN 'deploy' ELSE '' END AS workflow, event_type AS stage,
  {stamp} AS ts, concat('t', CAST(user_id % 23 AS STRING)) AS thread_id FROM {events} doc"""
CHAT_DUCK = "m AS (" + CHAT.format(stamp="strftime(ts, '%Y-%m-%dT%H:%M:%S')", events="events") + ")"


def chat_table(spark, sf):
    sql = CHAT.format(stamp="date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")", events="{events}")
    return spark.sql(sql, events=table(spark, sf, "events"))


@case("read_chat_table", f"""WITH {CHAT_DUCK} SELECT thread_id AS session_id, row_number() OVER (PARTITION BY thread_id ORDER BY ts, id) - 1 AS turn_index,
  CASE WHEN sender IN ('user', 'human') THEN 'user' ELSE 'assistant' END AS role, '[' || sender || '→' || recipient || CASE WHEN workflow <> '' THEN ' /' || workflow || '/' || stage ELSE '' END || '] ' || content AS content, ts FROM m""")
def read_chat_table(spark, sf):
    return chat.chat_to_turns(chat_table(spark, sf)).select("session_id", "turn_index", "role", "content", "ts")


@case("find_thread", f"""WITH {CHAT_DUCK} SELECT id, thread_id, 'exact' AS how FROM m WHERE thread_id = 't1'
 UNION ALL SELECT id, thread_id || '-', 'prefix' FROM m WHERE starts_with(thread_id, 't1')""")
def find_thread(spark, sf):
    m = chat_table(spark, sf)
    tailed = m.withColumn("thread_id", F.concat("thread_id", F.lit("-")))  # no id is 't1' now, many begin with it
    return chat.find_thread(m, "t1").select("id", "thread_id", F.lit("exact").alias("how")).unionByName(
        chat.find_thread(tailed, "t1").select("id", "thread_id", F.lit("prefix").alias("how")))


@case("list_threads", f"WITH {CHAT_DUCK} SELECT thread_id, count(*) AS msg_count, min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT sender) AS n_senders FROM m GROUP BY 1 ORDER BY last_ts DESC, thread_id LIMIT 10")
def list_threads(spark, sf):
    return chat.list_threads(chat_table(spark, sf), 10)


@case("thread_participants", f"WITH {CHAT_DUCK} SELECT DISTINCT thread_id, sender AS participant FROM m")
def thread_participants(spark, sf):
    return chat.thread_participants(chat_table(spark, sf))


@case("list_sessions", """SELECT 's' || conv_id AS session_id, 50000000 + conv_id * 10 AS size_bytes, '/w/' || (conv_id % 5) AS cwd, '1.' || min(turn) AS version
  FROM conversations GROUP BY conv_id ORDER BY conv_id DESC LIMIT 30""")
def list_sessions(spark, sf):
    return listing.list_sessions(event_lines(spark, sf), 30).select("session_id", "size_bytes", "cwd", "version")


@case("resolve_session", "SELECT DISTINCT 's' || conv_id AS session_id FROM conversations WHERE starts_with('s' || conv_id, 's1')")
def resolve_session(spark, sf):
    s = conv(spark, sf).select("session_id").distinct().withColumn("session_id", F.concat("session_id", F.lit("-")))
    return listing.find_sessions(s, "s1").select(F.rtrim("session_id", F.lit("-")).alias("session_id"))


@case("latest_session", "SELECT 's' || max(conv_id) AS session_id FROM conversations")
def latest_session(spark, sf):
    s = event_lines(spark, sf).groupBy("session_id").agg(F.max("mtime").alias("mtime"))
    return listing.latest(s).select("session_id")


@case("raw_manifest", "SELECT page_id, CAST(strlen(html) + 1 AS BIGINT) AS raw_size_bytes, sha256(html || chr(10)) AS raw_sha256, FALSE AS raw_truncated FROM pages")
def raw_manifest(spark, sf):
    """Every page is a file of its own here."""
    path = shared_dir(spark, "raw")
    pages = table(spark, sf, "pages").select("page_id", F.col("html").alias("value"))
    write_folders(pages, path, "page_id")
    found = listing.raw_manifest(spark, path, glob="*.txt")
    return found.select(F.regexp_extract("path", "page_id=([0-9]+)/", 1).cast("long").alias("page_id"), "raw_size_bytes", "raw_sha256", "raw_truncated")


def _by_folder(parse):
    def read(spark, path, **options):
        lines = base.read_lines(spark, path, "*.txt", **options)
        return parse(lines.withColumn("session_id", F.regexp_extract("path", "session_id=([^/]+)/", 1)))
    return read


@case("union_sources", f"""WITH {RAW_CTE}, a AS ({NUMBERED}), r AS ({ROLE_SQL})
 SELECT 'event_log' AS source, session_id, turn_index, role, content FROM a UNION ALL SELECT 'role_jsonl', session_id, turn_index, role, content FROM r""")
def union_sources(spark, sf):
    """Through files: lines are written as one file per session group and read back."""
    out = {}
    for name, lines in (("event_folders", event_lines(spark, sf)), ("role_folders", role_lines(spark, sf))):
        path = shared_dir(spark, name)
        write_folders(lines.withColumn("value", F.col("raw")), path, "session_id", order=("block", "seq"))
        out[name] = path
    # the writer names files itself, so here the folder is the session
    register_reader("event_folders", _by_folder(event_log.event_turns))
    register_reader("role_folders", _by_folder(messages.role_turns))
    return read_traces(spark, out).withColumn("source", F.when(
        F.col("source") == "event_folders", "event_log").otherwise("role_jsonl")).select("source", "session_id", "turn_index", "role", "content")


@case("write_tables", f"""WITH {CLEAN_SQL}, {FINGERPRINT_CTE}, kept AS (SELECT fingerprint, min(session_id) AS session_id FROM fp GROUP BY 1), cardq AS ({CARD_SQL})
 SELECT 'turns' AS table_name, session_id, turn_index, txt AS value FROM clean JOIN kept USING (session_id)
 UNION ALL SELECT 'steps', session_id, turn_index, substring(txt, 1, 280) FROM clean JOIN kept USING (session_id) WHERE {REAL_ASSISTANT}
 UNION ALL SELECT 'fingerprints', session_id, -1, fingerprint FROM kept
 UNION ALL SELECT 'cards', session_id, -1, query FROM cardq JOIN kept USING (session_id)
 UNION ALL SELECT t, session_id, -1, 'x-' || session_id || '-' || substring(fingerprint, 1, 12) FROM kept, (VALUES ('audit'), ('vectors')) v(t)""")
def write_tables(spark, sf):
    """The rows that a push has stored, table by table."""
    from tracelake.plans.jobs import push
    from tracelake.sources.sinks import read_gold

    path = shared_dir(spark, "gold")
    push(spark, turns(spark, sf).drop("conv_id"), path, agent_id="a1", batch="0")
    at = {name: read_gold(spark, path, name) for name in ("turns", "steps", "fingerprints", "cards", "audit", "vectors")}
    ids = at["fingerprints"].select("session_id", "experience_id")
    none = F.lit(-1).cast("long").alias("turn_index")
    rows = [at["turns"].select(F.lit("turns").alias("table_name"), "session_id", F.col("turn_index").cast("long"), F.col("content").alias("value")),
            at["steps"].select(F.lit("steps"), "session_id", F.col("turn_index").cast("long"), "step"),
            at["fingerprints"].select(F.lit("fingerprints"), "session_id", none, "fingerprint"),
            at["cards"].select(F.lit("cards"), "session_id", none, "query")]
    rows += [at[name].join(ids, "experience_id").select(F.lit(name), "session_id", none, "experience_id") for name in ("audit", "vectors")]
    return reduce(DataFrame.union, rows)
