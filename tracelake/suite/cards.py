"""Cards, titles, fingerprints, deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.functions import text as tx
from tracelake.functions.rules import DEFAULT_RULES
from tracelake.operators import cards as op
from tracelake.operators import digest
from tracelake.session import materialize
from tracelake.session import materialize
from tracelake.suite.registry import (
    case, hits_text, hits_text_sql, q, rule_steps, table, turns, turns_cte,
)

BLANK = " || ".join(f"chr({ord(c)})" for c in tx.BLANKS)


def strip_sql(e: str) -> str:
    return f"trim({e}, {BLANK})"


def flat_sql(e: str) -> str:
    return f"trim(regexp_replace({e}, '[\\s\\x{{1C}}-\\x{{1F}}\\x{{0B}}\\x{{85}}\\p{{Z}}]+', ' ', 'g'))"


def list_any(fn: str, e: str, items) -> str:
    return "(" + " OR ".join(f"{fn}({e}, {q(i)})" for i in items) + ")"


def bad_sql(e: str) -> str:
    low = strip_sql(f"lower({e})")
    return (f"(CASE WHEN coalesce({e}, '') = '' THEN TRUE WHEN {e} = {q(tx.GOOD_LITERAL)} THEN FALSE ELSE "
            f"{list_any('starts_with', low, tx.BAD_PREFIXES)} OR {list_any('contains', low, tx.BAD_FRAGMENTS)} "
            f"OR ends_with({e}, '…') OR ends_with({e}, '...') END)")


def title_sql(e: str, default: str = q(tx.UNSPECIFIED)) -> str:
    """Scalar expression of the heuristic title over text expression ``e``."""
    line = strip_sql(f"regexp_extract({strip_sql(e)}, '^[^\\n\\r]*')")
    head = f"substring({line}, 1, 120)"
    ends = ", ".join(f"CASE WHEN instr({head}, {q(s)}) > 1 THEN instr({head}, {q(s)}) - 1 + {len(s)} END"
                     for s in tx.SEPARATORS[:-1])
    cut = f"coalesce(least({ends}), length({head}))"
    t = flat_sql(f"substring({head}, 1, {cut})")
    return (f"CASE WHEN {t} = '' THEN {default} WHEN length({t}) > 70 "
            f"THEN rtrim(substring({t}, 1, 69)) || '…' ELSE {t} END")


MARKER = "(?im)^\\s*\\[task-summary\\]\\s*[:：]\\s*(.+?)\\s*$"


def marker_sql(e: str, limit: int = 60, reject: bool = True) -> str:
    last = f"list_extract(regexp_extract_all({e}, {q(MARKER)}, 1), -1)"
    lab = strip_sql(f"trim({flat_sql(last)}, {q(tx.QUOTES)})")
    lab = strip_sql(f"regexp_replace({lab}, '[。.!?！？:：]$', '')")
    ok = f"{lab} <> ''" + (f" AND NOT {bad_sql(lab)}" if reject else "")
    return f"CASE WHEN {ok} THEN CASE WHEN length({lab}) > {limit} THEN substring({lab}, 1, {limit}) || '…' ELSE {lab} END END"


REAL_USER = (f"role = 'user' AND {strip_sql('txt')} <> '' AND NOT "
             f"{list_any('starts_with', f'ltrim(txt, {BLANK})', tx.WRAPPER_PREFIXES)}")
REAL_ASSISTANT = f"role = 'assistant' AND {strip_sql('txt')} <> ''"
SUMS = ", ".join(f"sum(h_{r.name} + t_{r.name}) AS h_{r.name}" for r in DEFAULT_RULES)
TOOL_COUNTS = ", ".join(f"t.h_{r.name} AS t_{r.name}" for r in DEFAULT_RULES)

CLEAN_SQL = (
    turns_cte() + ",\n" + rule_steps("turns", "content", tag="r") + ",\n"
    + rule_steps("turns", "CASE WHEN call_id <> '' THEN tool_cmd ELSE '' END", tag="t",
                 keep="session_id AS sid, turn_index AS tix")
    + f""",
clean AS (SELECT r.*, t.txt AS cmd, {TOOL_COUNTS} FROM r JOIN t ON r.session_id = t.sid AND r.turn_index = t.tix)""")

CARD_SQL = f"""WITH {CLEAN_SQL},
parts AS (SELECT session_id, turn_index, *, CASE WHEN {REAL_USER} THEN txt END AS ask,
  CASE WHEN {REAL_ASSISTANT} THEN substring(txt, 1, 500) END AS reply, {marker_sql('txt')} AS marker FROM clean),
agg AS (SELECT session_id, arg_min(ask, turn_index) FILTER (ask IS NOT NULL) AS ask,
  arg_max(reply, turn_index) FILTER (reply IS NOT NULL) AS reply,
  arg_max(marker, turn_index) FILTER (marker IS NOT NULL) AS marker, count(reply) AS n_steps, {SUMS}
  FROM parts GROUP BY session_id)
SELECT session_id, coalesce(ask, '(no user turn)') AS query,
  coalesce(marker, {title_sql("coalesce(ask, '')")}) AS intent,
  coalesce(reply, '(no assistant turn)') AS outcome, n_steps, 'misc' AS task_type, 'medium' AS sensitivity,
  'private' AS acl, {hits_text_sql()} AS redactions FROM agg"""


@case("card_build", CARD_SQL)
def card_build(spark, sf):
    cards = op.card_build(turns(spark, sf))
    return cards.withColumn("redactions", hits_text("redactions")).drop("tags")


@case("card_steps", f"""WITH {CLEAN_SQL}
SELECT session_id, turn_index, substring(txt, 1, 280) AS step FROM clean WHERE {REAL_ASSISTANT}""")
def card_steps(spark, sf):
    return op.card_steps(op.redact_turns(turns(spark, sf), tool_inputs=False))


@case("card_with_steps", f"""WITH {CLEAN_SQL},
s AS (SELECT session_id, turn_index, substring(txt, 1, 280) AS step, (row_number() OVER (PARTITION BY session_id ORDER BY turn_index) - 1) // 3 AS part_no
  FROM clean WHERE {REAL_ASSISTANT}),
p AS (SELECT session_id, part_no, string_agg(step, '|' ORDER BY turn_index) AS steps FROM s GROUP BY ALL),
c AS (SELECT session_id, count(*) FILTER ({REAL_ASSISTANT}) AS n_steps FROM clean GROUP BY session_id)
SELECT session_id, n_steps, coalesce(part_no, 0) AS part_no, coalesce(steps, '') AS steps FROM c LEFT JOIN p USING (session_id)""")
def card_with_steps(spark, sf):
    # three readers of the redacted turns: the rules run once, the result is stored
    clean = materialize(op.redact_turns(turns(spark, sf), tool_inputs=False), "clean")
    out = op.attach_steps(op.card_core(clean), op.card_steps(clean), part=3)
    return out.select("session_id", "n_steps", "part_no", F.array_join("steps", "|").alias("steps"))


BF_USER = (f"role = 'user' AND {strip_sql('txt')} <> '' AND NOT "
           f"{list_any('starts_with', f'ltrim(txt, {BLANK})', tx.BACKFILL_USER_MARKS)}")
BF_ASSISTANT = (f"role = 'assistant' AND {strip_sql('txt')} <> '' AND NOT "
                f"{list_any('starts_with', f'ltrim(txt, {BLANK})', tx.BACKFILL_ASSISTANT_MARKS)}")
BF_BODY = f"regexp_replace({strip_sql('ask')}, '\\A(?:(?:```|>|<)[^\\n]*\\n\\s*)+', '')"


@case("card_backfill", f"""WITH {turns_cte()}, {rule_steps('turns', 'content', tag='r')},
agg AS (SELECT session_id, arg_min(txt, turn_index) FILTER ({BF_USER}) AS ask,
  arg_max(substring(txt, 1, 512), turn_index) FILTER ({BF_ASSISTANT}) AS reply, count(*) AS n,
  arg_max({marker_sql('txt', 70, False)}, turn_index) FILTER ({marker_sql('txt', 70, False)} IS NOT NULL) AS marker
  FROM r GROUP BY session_id)
SELECT session_id, substring(coalesce(ask, '(no user message)'), 1, 512) AS query,
  coalesce(marker, {title_sql(f"coalesce({BF_BODY}, '')", "'lake session'")}) AS intent,
  'replay session ' || session_id || ' (' || n || ' turns)' AS step,
  coalesce(reply, '(no assistant reply)') AS outcome, 'lake-backfill' AS task_type, 'private' AS acl,
  'backfill,src:lake' AS tags FROM agg""")
def card_backfill(spark, sf):
    return op.card_backfill(turns(spark, sf), "lake").withColumn("tags", F.array_join("tags", ","))


@case("task_summary_title", f"""WITH {turns_cte()},
m AS (SELECT session_id, turn_index, {marker_sql('content')} AS t FROM turns)
SELECT session_id, arg_max(t, turn_index) AS title FROM m WHERE t IS NOT NULL GROUP BY session_id""")
def task_summary_title(spark, sf):
    return op.task_summary_title(turns(spark, sf))


@case("heuristic_title", f"SELECT doc_id, {title_sql('text')} AS title FROM documents")
def heuristic_title(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.heuristic_title(F.col("text")).alias("title"))


FENCED = "concat('```sql', chr(10), '> quoted', chr(10), ' <tag>', chr(10), text)"
FENCED_BODY = f"regexp_replace({strip_sql(FENCED)}, '\\A(?:(?:```|>|<)[^\\n]*\\n\\s*)+', '')"


@case("backfill_title", f"SELECT doc_id, {title_sql(FENCED_BODY, chr(39) + 'lake session' + chr(39))} AS title FROM documents")
def backfill_title(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", tx.backfill_title(F.expr(FENCED), F.lit("lake")).alias("title"))


LABELS = ("concat(CASE doc_id % 6 WHEN 0 THEN '' WHEN 1 THEN '- ' WHEN 2 THEN '\"' WHEN 3 THEN '2. ' "
          "WHEN 4 THEN concat('[task-summary]: x', chr(10), 'Fix ') ELSE 'Sure, ' END, coalesce(text, ''), "
          "CASE doc_id % 3 WHEN 0 THEN '.' WHEN 1 THEN '...' ELSE '' END)")


@case("looks_bad_title", f"SELECT doc_id, {bad_sql('label')} AS bad FROM (SELECT doc_id, {LABELS} AS label FROM documents)")
def looks_bad_title(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", tx.looks_bad_title(F.expr(LABELS)).alias("bad"))


def clean_sql(e: str) -> str:
    lines = f"list_transform(regexp_split_to_array({strip_sql(e)}, '[\\n\\r]'), lambda x: {strip_sql('x')})"
    notice = "x = '' OR " + list_any("starts_with", "x", tx.NOTICE_PREFIXES)
    first = f"coalesce(list_extract(list_filter({lines}, lambda x: NOT ({notice})), 1), '')"
    return strip_sql(f"trim({strip_sql(f'ltrim({first}, {q(tx.BULLETS)})')}, {q(tx.QUOTES)})")


@case("clean_label", f"""SELECT doc_id, CASE WHEN lower(lab) IN ('', '(no task)', '(none)') OR {bad_sql('lab')} THEN NULL
  WHEN length(lab) > 60 THEN substring(lab, 1, 59) || '…' ELSE lab END AS label FROM
 (SELECT doc_id, {flat_sql("regexp_replace(l0, '[。.!?！？:：]$', '')")} AS lab FROM
  (SELECT doc_id, {clean_sql(LABELS)} AS l0 FROM documents))""")
def clean_label(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.clean_label(F.expr(LABELS)).alias("label"))


@case("intent", f"""WITH {turns_cte()},
m AS (SELECT session_id, turn_index, role, content AS txt, {marker_sql('content')} AS t FROM turns),
a AS (SELECT session_id, arg_max(t, turn_index) FILTER (t IS NOT NULL) AS marker,
  arg_min(txt, turn_index) FILTER ({REAL_USER}) AS ask FROM m GROUP BY session_id)
SELECT session_id, CASE WHEN marker IS NOT NULL THEN marker
  WHEN CAST(substring(session_id, 2) AS BIGINT) % 2 = 0 THEN 'Review change ' || session_id
  ELSE {title_sql("coalesce(ask, '')")} END AS intent FROM a""")
def intent(spark, sf):
    plain = turns(spark, sf)
    cards = op.card_core(plain.withColumn("redactions", F.create_map().cast("map<string,bigint>")))
    labels = plain.select("session_id").distinct().select("session_id", F.when(
        F.substring("session_id", 2, 20).cast("long") % 2 == 0,
        F.concat(F.lit("- Review change "), "session_id", F.lit("."))).otherwise("(none)").alias("label"))
    return op.intents(cards, labels).select("session_id", "intent")


@case("flatten_ws", f"SELECT doc_id, {flat_sql('text')} AS flat FROM documents")
def flatten_ws(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.flatten_ws(F.col("text")).alias("flat"))


DIGEST = ("sha256(concat_ws(chr(31), CAST(row_number() OVER (PARTITION BY session_id ORDER BY turn_index) - 1 AS VARCHAR), sha256(concat_ws(chr(31), role, "
          + flat_sql("content") + ", CASE WHEN call_id <> '' THEN tool_name ELSE '' END))))")
LIMBS = ", ".join(f"CAST(sum(CAST('0x' || substring(h, {1 + 7 * i}, 7) AS BIGINT)) AS VARCHAR)" for i in range(op.PIECES))
FINGERPRINT_CTE = f"""fp AS (SELECT session_id, count(*) AS n_turns,
  sha256(concat_ws('-', CAST(count(*) AS VARCHAR), {LIMBS})) AS fingerprint
  FROM (SELECT session_id, {DIGEST} AS h FROM turns) GROUP BY session_id)"""


@case("fingerprint", f"WITH {turns_cte()}, {FINGERPRINT_CTE} SELECT * FROM fp")
def fingerprint(spark, sf):
    return op.fingerprint(turns(spark, sf))


@case("fingerprint_grown", f"WITH {turns_cte()}, {FINGERPRINT_CTE} SELECT * FROM fp")
def fingerprint_grown(spark, sf):
    """Every session arrives in three parts, of which the later ones repeat the earlier; each part is hashed once."""
    t = turns(spark, sf)
    cut = t.groupBy("session_id").agg(F.max("turn_index").alias("_m"))
    t = t.join(cut, "session_id")
    state = digest.digest_state(t.filter("3 * turn_index <= _m"))
    for part in ("3 * turn_index <= 2 * _m", "TRUE"):
        state = materialize(digest.grown(materialize(state, "state"), t.filter(part)), "state")
    return digest.fingerprint_of(state)


@case("session_stats", f"""WITH {turns_cte()} SELECT session_id, count(*) AS turn_count,
  CAST(sum(length(content)) AS BIGINT) AS content_len FROM turns GROUP BY session_id""")
def session_stats(spark, sf):
    return op.session_stats(turns(spark, sf))
