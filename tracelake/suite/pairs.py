"""Pairs, context, prompts, transcripts, segments, rewards."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.functions import text as tx
from tracelake.operators import pairs as op
from tracelake.operators import rewards as rw
from tracelake.schema import REWARD_DIMS
from tracelake.suite.cards import marker_sql, strip_sql
from tracelake.session import shared_dir
from tracelake.sources import hashed
from tracelake.suite.registry import case, table, turns, turns_cte

PAIRS_CTE = turns_cte() + f""",
marks AS (SELECT session_id, turn_index, role = 'user' AND {strip_sql('content')} <> '' AS asks,
  role = 'assistant' AS answers FROM turns),
seen AS (SELECT *, last_value(CASE WHEN asks THEN turn_index END IGNORE NULLS) OVER w AS user_idx,
  last_value(CASE WHEN answers THEN turn_index END IGNORE NULLS) OVER w AS prev FROM marks
  WINDOW w AS (PARTITION BY session_id ORDER BY turn_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
pairs AS (SELECT session_id, user_idx, turn_index AS assistant_idx,
  row_number() OVER (PARTITION BY session_id ORDER BY turn_index) AS pair_no,
  count(*) OVER (PARTITION BY session_id) AS n_pairs FROM seen
  WHERE answers AND user_idx IS NOT NULL AND (prev IS NULL OR prev < user_idx))"""


def pairs_of(spark, sf):
    return op.evaluable_pairs(turns(spark, sf))


@case("evaluable_pairs", f"WITH {PAIRS_CTE} SELECT * FROM pairs")
def evaluable_pairs(spark, sf):
    return pairs_of(spark, sf)


@case("turn_pair_join", f"""WITH {PAIRS_CTE} SELECT p.session_id, p.user_idx, p.assistant_idx,
  length(u.content) AS ask_len, length(a.content) AS reply_len FROM pairs p
  JOIN turns u ON u.session_id = p.session_id AND u.turn_index = p.user_idx
  JOIN turns a ON a.session_id = p.session_id AND a.turn_index = p.assistant_idx""")
def turn_pair_join(spark, sf):
    t = turns(spark, sf)
    ask = t.select("session_id", F.col("turn_index").alias("user_idx"), F.length("content").cast("long").alias("ask_len"))
    rep = t.select("session_id", F.col("turn_index").alias("assistant_idx"), F.length("content").cast("long").alias("reply_len"))
    return (op.evaluable_pairs(t).drop("pair_no", "n_pairs").join(ask, ["session_id", "user_idx"])
            .join(rep, ["session_id", "assistant_idx"]))


@case("select_turns_first", f"WITH {PAIRS_CTE} SELECT * FROM pairs WHERE pair_no <= 2")
def select_turns_first(spark, sf):
    return op.select_turns_first(pairs_of(spark, sf), 2)


EVEN = f"""WITH {PAIRS_CTE},
n AS (SELECT DISTINCT session_id, n_pairs FROM pairs),
idx AS (SELECT DISTINCT session_id, CAST(round_even(i * ((n_pairs - 1) / 2.0), 0) AS BIGINT) AS no FROM n, range(3) r(i)
  UNION SELECT session_id, 0 FROM n UNION SELECT session_id, n_pairs - 1 FROM n),
pick AS (SELECT session_id, no FROM idx QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY no) <= 3)
SELECT p.* FROM pairs p WHERE n_pairs <= 3 OR EXISTS (
  SELECT 1 FROM pick k WHERE k.session_id = p.session_id AND k.no = p.pair_no - 1)"""


@case("select_turns_even", EVEN)
def select_turns_even(spark, sf):
    return op.select_turns_even(pairs_of(spark, sf), 3)


@case("select_turns_important", EVEN)
def select_turns_important(spark, sf):
    return op.select_turns_important(pairs_of(spark, sf), 3)


@case("select_turns_ranked", f"""WITH {PAIRS_CTE} SELECT p.*, CAST(CASE WHEN call_id <> '' THEN 1 ELSE 0 END AS BIGINT) AS n_calls,
  length(content) AS n_chars, row_number() OVER (PARTITION BY p.session_id ORDER BY
    CASE WHEN call_id <> '' THEN 1 ELSE 0 END DESC, length(content) DESC, assistant_idx) AS rank_no
  FROM pairs p JOIN turns t ON t.session_id = p.session_id AND t.turn_index = p.assistant_idx QUALIFY rank_no <= 2""")
def select_turns_ranked(spark, sf):
    t = turns(spark, sf)
    return op.select_turns_ranked(t, op.evaluable_pairs(t), 2)


def formatted(content: str, p: str = "") -> str:
    spaced = f"""concat('{{"cmd": "', {p}tool_cmd, '", "n": 1}}')"""
    return strip_sql(f"{content} || CASE WHEN {p}call_id <> '' THEN chr(10) || '[Tool: ' || {p}tool_name || '] ' "
                     f"|| substring({spaced}, 1, 600) ELSE '' END")


CONTEXT_CTE = PAIRS_CTE + f""",
el AS (SELECT session_id, turn_index, CASE WHEN role = 'user' THEN 'User: ' || substring(content, 1, 800)
  ELSE 'Assistant: ' || substring({formatted('substring(content, 1, 800)')}, 1, 800) END AS line
  FROM turns WHERE role IN ('user', 'assistant') AND ({strip_sql('substring(content, 1, 800)')} <> '' OR call_id <> '')),
nxt AS (SELECT p.session_id, p.assistant_idx, e.turn_index, e.line FROM pairs p JOIN el e
  ON e.session_id = p.session_id AND e.turn_index > p.assistant_idx
  QUALIFY row_number() OVER (PARTITION BY p.session_id, p.assistant_idx ORDER BY e.turn_index) <= 4),
ctx AS (SELECT session_id, assistant_idx, string_agg(line, chr(10) || chr(10) ORDER BY turn_index) AS s FROM nxt GROUP BY ALL),
full_ctx AS (SELECT p.*, coalesce(s, '') AS subsequent FROM pairs p LEFT JOIN ctx USING (session_id, assistant_idx))"""


@case("subsequent_context", f"WITH {CONTEXT_CTE} SELECT * FROM full_ctx")
def subsequent_context(spark, sf):
    t = turns(spark, sf)
    return op.subsequent_context(t, op.evaluable_pairs(t))


@case("subsequent_join", f"""WITH {PAIRS_CTE} SELECT p.session_id, p.assistant_idx,
  count(t.turn_index) AS n_later FROM pairs p LEFT JOIN turns t ON t.session_id = p.session_id
  AND t.turn_index > p.assistant_idx AND t.role IN ('user', 'assistant') GROUP BY ALL""")
def subsequent_join(spark, sf):
    # how many later turns there are comes from running numbers, not from a range self-join
    t = turns(spark, sf).filter(F.col("role").isin("user", "assistant"))
    numbered = op.running(t.select("session_id", "turn_index"), ["session_id"], ["turn_index"],
                          sums={"no": F.lit(1)}, totals={"n_all": "no"}, inclusive=True)
    later = numbered.select("session_id", F.col("turn_index").alias("assistant_idx"),
                            (F.col("n_all") - F.col("no")).alias("n_later"))
    return op.evaluable_pairs(turns(spark, sf)).select("session_id", "assistant_idx").join(
        later, ["session_id", "assistant_idx"])


@case("format_assistant", f"""WITH {turns_cte()} SELECT session_id, turn_index,
  {formatted('content')} AS formatted FROM turns WHERE role = 'assistant'""")
def format_assistant(spark, sf):
    return turns(spark, sf).filter("role = 'assistant'").select(
        "session_id", "turn_index", tx.format_assistant(F.col("content"), F.col("tool_calls")).alias("formatted"))


@case("judge_input", f"""WITH {CONTEXT_CTE} SELECT c.session_id, c.assistant_idx,
  '<user>' || chr(10) || {strip_sql('u.content')} || chr(10) || '</user>' || chr(10) || chr(10) || '<assistant>' || chr(10)
  || {formatted('a.content', 'a.')}
  || chr(10) || '</assistant>' || chr(10) || chr(10) || '<subsequent>' || chr(10)
  || CASE WHEN c.subsequent = '' THEN '(no follow-up turns)' ELSE c.subsequent END || chr(10) || '</subsequent>' AS prompt
  FROM full_ctx c JOIN turns u ON u.session_id = c.session_id AND u.turn_index = c.user_idx
  JOIN turns a ON a.session_id = c.session_id AND a.turn_index = c.assistant_idx""")
def judge_input(spark, sf):
    t = turns(spark, sf)
    return op.judge_input(t, op.evaluable_pairs(t)).select("session_id", "assistant_idx", "prompt")


LINE_SQL = f"""CASE WHEN role = 'user' AND c <> '' THEN '[用户] ' || substring(c, 1, 600)
  WHEN role = 'assistant' AND call_id <> '' THEN '[助手→工具] ' || tool_name
  WHEN role = 'assistant' AND c <> '' THEN '[助手] ' || substring(c, 1, 600)
  WHEN role = 'tool' AND c <> '' THEN '[工具结果] ' || replace(substring(c, 1, 120), chr(10), ' ') ||
    CASE WHEN length(c) > 120 THEN '…' ELSE '' END END"""


@case("pack_transcript", f"""WITH {turns_cte()},
l AS (SELECT session_id, turn_index, {LINE_SQL} AS line FROM (SELECT *, {strip_sql('content')} AS c FROM turns)),
u AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY session_id ORDER BY turn_index
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM l WHERE line IS NOT NULL),
x AS (SELECT session_id, min(turn_index) FILTER (used + length(line) > 900) AS cut FROM u GROUP BY session_id)
SELECT u.session_id, coalesce(string_agg(line, chr(10) ORDER BY turn_index) FILTER (cut IS NULL OR turn_index < cut), '')
  || CASE WHEN max(cut) IS NULL THEN '' WHEN count(*) FILTER (turn_index < cut) = 0 THEN '...(truncated)'
     ELSE chr(10) || '...(truncated)' END AS transcript
FROM u JOIN x USING (session_id) GROUP BY u.session_id""")
def pack_transcript(spark, sf):
    return op.pack_transcript(turns(spark, sf), 900)


@case("segment_tasks", f"""WITH {turns_cte()},
m AS (SELECT session_id, turn_index, {marker_sql('content', 60, False)} AS marker FROM turns)
SELECT session_id, turn_index, CAST(coalesce(sum(CASE WHEN marker IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY session_id
  ORDER BY turn_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS segment_id, marker FROM m""")
def segment_tasks(spark, sf):
    return op.segment_tasks(turns(spark, sf)).select("session_id", "turn_index", "segment_id", "marker")


# --- rewards: replies are derived from the pairs by arithmetic -----------------------------

def replies_sql(source: str, lb: str = "{", rb: str = "}") -> str:
    dims = ", ".join(
        f"'\"{d}\": ', CASE WHEN (conv_id + assistant_idx) % 9 = {i} THEN '\"x\"' ELSE "
        f"CAST((conv_id * {i + 3} + assistant_idx) % 5 - 2 AS STRING) END, ', '"
        for i, d in enumerate(REWARD_DIMS))
    body = (f"concat('{lb}', {dims}, '\"confidence\": ', CAST((conv_id * 37 + assistant_idx) % 151 AS STRING), "
            f"'e-2, \"reason\": \"because ', CAST(conv_id AS STRING), '\"{rb}')")
    return f"""SELECT session_id AS experience_id, assistant_idx AS turn_index, user_idx AS user_turn_index, judge_model,
  conv_id, CASE WHEN conv_id % 17 = 3 THEN concat({body}, ' or maybe ', {body}) WHEN conv_id % 17 = 5 THEN replace({body}, '"', chr(39))
    WHEN conv_id % 17 = 7 THEN '{lb}"outcome": 1, "confidence": true{rb}' ELSE CASE (conv_id + assistant_idx) % 6 WHEN 0 THEN concat(chr(96), chr(96), chr(96), 'json', chr(10), {body}, chr(10), chr(96), chr(96), chr(96))
    WHEN 1 THEN concat('My view: ', {body}, ' Done.') WHEN 2 THEN CASE WHEN conv_id % 4 = 0 THEN 'no json here' ELSE {body} END
    ELSE {body} END END AS raw
  FROM {source}"""


JUDGED_SQL = """SELECT session_id, user_idx, assistant_idx, CAST(substring(session_id, 2) AS BIGINT) AS conv_id, 'judge-a' AS judge_model FROM {0}
  UNION ALL SELECT session_id, user_idx, assistant_idx, CAST(substring(session_id, 2) AS BIGINT) + 1, 'judge-b' FROM {0}"""


def replies(spark, sf):
    judged = spark.sql(JUDGED_SQL.format("{p}"), p=pairs_of(spark, sf))
    return spark.sql(replies_sql("{judged}", "{{", "}}"), judged=judged)


REPLIES_CTE = (PAIRS_CTE + ", judged AS (" + JUDGED_SQL.format("pairs") + "), replies AS ("
               + replies_sql("judged") + ")")


def _dim_sql(d: str) -> str:
    v = f"json_extract_string(obj, '$.{d}')"
    return f"CAST(greatest(-1, least(1, coalesce(TRY_CAST({v} AS BIGINT), 0))) AS INTEGER) AS {d}"


REWARDS_CTE = REPLIES_CTE + f""",
objs AS (SELECT *, CASE WHEN json_valid(regexp_extract(raw, '(?s)\\{{.*\\}}')) THEN regexp_extract(raw, '(?s)\\{{.*\\}}') END AS obj FROM replies),
rewards AS (SELECT experience_id, turn_index, user_turn_index, judge_model, conv_id, {', '.join(_dim_sql(d) for d in REWARD_DIMS)},
  greatest(0.0, least(1.0, coalesce(CASE json_extract_string(obj, '$.confidence') WHEN 'true' THEN 1.0 ELSE TRY_CAST(json_extract_string(obj, '$.confidence') AS DOUBLE) END, 0.5))) AS confidence,
  substring(coalesce(json_extract_string(obj, '$.reason'), ''), 1, 500) AS reason FROM objs WHERE obj IS NOT NULL)"""


@case("parse_judge_reply", f"WITH {REWARDS_CTE} SELECT experience_id, turn_index, judge_model, obj FROM objs")
def parse_judge_reply(spark, sf):
    return replies(spark, sf).select("experience_id", "turn_index", "judge_model",
                                     rw.parse_judge_reply(F.col("raw")).alias("obj"))


@case("validate_reward", f"WITH {REWARDS_CTE} SELECT * FROM rewards")
def validate_reward(spark, sf):
    return rw.validate_reward(replies(spark, sf))[0]


@case("reward_failures", f"WITH {REWARDS_CTE} SELECT 'non-json response' AS error, count(*) AS n FROM objs WHERE obj IS NULL HAVING count(*) > 0")
def reward_failures(spark, sf):
    return rw.reward_failures(rw.validate_reward(replies(spark, sf))[1])


MEANS = ", ".join(f"round_even(sum({d})::DOUBLE / count(*), 3) + 0.0::DOUBLE AS mean_{d}" for d in REWARD_DIMS)
SCORE = " + ".join(f"mean_{d} * {w}::DOUBLE" for d, w in rw.WEIGHTS.items())


@case("reward_summary", f"""WITH {REWARDS_CTE} SELECT *, round_even({SCORE}, 3) + 0.0::DOUBLE AS trajectory_score FROM
 (SELECT experience_id, count(*) AS n, {MEANS}, round_even(avg(confidence), 3) AS confidence_mean FROM rewards GROUP BY 1)""")
def reward_summary(spark, sf):
    return rw.reward_summary(rw.validate_reward(replies(spark, sf))[0])


UPSERT_SQL = f"""WITH {REWARDS_CTE}, both_sides AS (
  SELECT experience_id, turn_index, judge_model, 1 AS arrival, outcome, confidence FROM rewards
  UNION ALL SELECT experience_id, turn_index, judge_model, 2, -outcome, confidence / 2 FROM rewards WHERE conv_id % 2 = 0)
 SELECT * FROM both_sides QUALIFY row_number() OVER (PARTITION BY experience_id, turn_index, judge_model ORDER BY arrival DESC) = 1"""


@case("reward_upsert", UPSERT_SQL)
def reward_upsert(spark, sf):
    return rw.reward_upsert(*reward_rows(spark, sf))


def reward_rows(spark, sf):
    r = rw.validate_reward(replies(spark, sf))[0]
    cols = ["experience_id", "turn_index", "judge_model"]
    old = r.select(*cols, F.lit(1).alias("arrival"), "outcome", "confidence")
    new = r.filter("conv_id % 2 = 0").select(*cols, F.lit(2).alias("arrival"), (-F.col("outcome")).alias("outcome"),
                                             (F.col("confidence") / 2).alias("confidence"))
    return old, new


@case("reward_upsert_stored", UPSERT_SQL)
def reward_upsert_stored(spark, sf):
    """The same on a stored table: only folders that hold a changed key are written."""
    old, new = reward_rows(spark, sf)
    path = shared_dir(spark, "rewards")
    hashed.write_hashed(old, path, "experience_id")
    hashed.upsert_hashed(spark, path, new, "experience_id", ["experience_id", "turn_index", "judge_model"])
    return hashed.read_hashed(spark, path)


@case("reward_join", f"""WITH {REWARDS_CTE}, e AS (SELECT DISTINCT session_id AS experience_id FROM turns)
 SELECT e.experience_id, CAST(r.turn_index AS VARCHAR) AS turn_index, CAST(r.outcome AS VARCHAR) AS outcome, r.confidence FROM e LEFT JOIN rewards r
 ON r.experience_id = e.experience_id AND r.judge_model = 'judge-b'""")
def reward_join(spark, sf):
    e = turns(spark, sf).select(F.col("session_id").alias("experience_id")).distinct()
    r = rw.validate_reward(replies(spark, sf))[0]
    return rw.reward_join(e, r, "judge-b").select(
        "experience_id", F.col("turn_index").cast("string").alias("turn_index"),
        F.col("outcome").cast("string").alias("outcome"), "confidence")


@case("judge_agreement", f"""WITH {REWARDS_CTE} SELECT a.judge_model AS judge_a, b.judge_model AS judge_b, count(*) AS n,
  count(*) FILTER (a.outcome = b.outcome) AS same, round_even(sum(abs(a.outcome - b.outcome))::DOUBLE / count(*), 6) AS mean_gap
  FROM rewards a JOIN rewards b ON a.experience_id = b.experience_id AND a.turn_index = b.turn_index
  AND a.judge_model < b.judge_model GROUP BY ALL""")
def judge_agreement(spark, sf):
    return rw.judge_agreement(rw.validate_reward(replies(spark, sf))[0])
