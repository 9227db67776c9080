"""One card per session, its step table, titles, fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake import schema as sc
from tracelake.functions import text as tx
from tracelake.functions.redact import HITS_TYPE, hit_sums, merge_hits, redact, redact_tree
from tracelake.functions.rules import DEFAULT_RULES, Rule
from tracelake.operators.scan import running


def redact_turns(turns: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES,
                 tool_inputs: bool = True) -> DataFrame:
    """Content and tool inputs rewritten, ``redactions`` added. Content stays on the JVM;
    only the JSON inputs of tool calls pass through the Arrow tree walk."""
    out = turns.withColumn("_c", redact(F.coalesce(F.col("content"), F.lit("")), rules))
    keep = [c for c in turns.columns if c not in ("content", "tool_calls")]
    if not (tool_inputs and "tool_calls" in turns.columns):
        extra = ["tool_calls"] if "tool_calls" in turns.columns else []
        return out.select(*keep, F.col("_c.text").alias("content"), *extra,
                          F.col("_c.hits").alias("redactions"))
    walked = redact_tree(rules)(F.when(F.size("tool_calls") > 0, _as_json_array(F.col("tool_calls"))))
    out = out.withColumn("_t", walked)
    clean_inputs = F.from_json(F.col("_t.json"), "array<string>")
    calls = F.when(F.size("tool_calls") > 0, F.zip_with(
        F.col("tool_calls"), clean_inputs,
        lambda c, j: F.struct(c["id"].alias("id"), c["name"].alias("name"), j.alias("input"))
    )).otherwise(F.col("tool_calls"))
    return out.select(
        *keep, F.col("_c.text").alias("content"), calls.alias("tool_calls"),
        merge_hits(F.col("_c.hits"), F.coalesce(F.col("_t.hits"), F.create_map().cast(HITS_TYPE)))
        .alias("redactions"))


def _as_json_array(calls: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(
        F.transform(calls, lambda c: F.coalesce(c["input"], F.lit("{}"))), ","), F.lit("]"))


def card_core(clean: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, task_type: str = "misc",
              sensitivity: str = "medium", acl: str = "private", tags: tuple[str, ...] = ()) -> DataFrame:
    """Cards from already redacted turns: one aggregation, combined on the map side."""
    role, body = F.col("role"), F.col("content")
    rows = clean.select(
        "session_id", "turn_index", "redactions",
        F.when(tx.is_real_user(role, body), body).alias("ask"),
        F.when(tx.is_real_assistant(role, body), F.substring(body, 1, 500)).alias("reply"),
        tx.marker_label(body).alias("marker"))
    first = F.expr("min_by(ask, turn_index) FILTER (WHERE ask IS NOT NULL)")
    last = F.expr("max_by(reply, turn_index) FILTER (WHERE reply IS NOT NULL)")
    named = F.expr("max_by(marker, turn_index) FILTER (WHERE marker IS NOT NULL)")
    cards = rows.groupBy("session_id").agg(
        first.alias("ask"), last.alias("reply"), named.alias("marker"),
        F.count("reply").alias("n_steps"), hit_sums("redactions", rules).alias("redactions"))
    return cards.select(
        "session_id",
        F.coalesce("ask", F.lit(sc.NO_USER)).alias("query"),
        F.coalesce(F.col("marker"), tx.heuristic_title(F.coalesce("ask", F.lit("")))).alias("intent"),
        F.coalesce("reply", F.lit(sc.NO_ASSISTANT)).alias("outcome"),
        "n_steps", F.lit(task_type).alias("task_type"), F.lit(sensitivity).alias("sensitivity"),
        F.lit(acl).alias("acl"), F.array(*[F.lit(t) for t in tags]).cast("array<string>").alias("tags"),
        "redactions")


def card_build(turns: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, **constants) -> DataFrame:
    """Redact first, then derive the card. The steps of a session are the ``card_steps``
    rows, so a session of any length stays distributed."""
    return card_core(redact_turns(turns, rules), rules, **constants)


def card_steps(clean: DataFrame) -> DataFrame:
    """(session_id, turn_index, step): every non-blank assistant turn, first 280 characters."""
    return clean.filter(tx.is_real_assistant(F.col("role"), F.col("content"))).select(
        "session_id", "turn_index", F.substring("content", 1, 280).alias("step"))


def attach_steps(cards: DataFrame, steps: DataFrame, part: int = 1000) -> DataFrame:
    """Cards with their steps as arrays of ``part`` steps: one row per ``part_no`` (from 0),
    for short and long sessions alike; a card without steps has one empty part."""
    placed = running(steps, ["session_id"], ["turn_index"], sums={"_at": F.lit(1)})
    lists = (placed.groupBy("session_id", F.floor(F.col("_at") / F.lit(part)).cast("long").alias("part_no"))
             .agg(F.array_sort(F.collect_list(F.struct("turn_index", "step"))).alias("_s"))
             .select("session_id", "part_no", F.transform("_s", lambda s: s["step"]).alias("steps")))
    return (cards.join(lists, "session_id", "left").withColumn("part_no", F.coalesce("part_no", F.lit(0).cast("long")))
            .withColumn("steps", F.coalesce("steps", F.array().cast("array<string>"))))


def card_backfill(turns: DataFrame, source: str, rules: tuple[Rule, ...] = DEFAULT_RULES) -> DataFrame:
    """The bulk-import card: 512-character query and outcome, one synthetic step, fixed
    private access. Redacted like every other write."""
    clean = redact_turns(turns, rules, tool_inputs=False)
    role, body = F.col("role"), F.col("content")
    rows = clean.select(
        "session_id", "turn_index",
        F.when(tx.is_backfill_user(role, body), body).alias("ask"),
        F.when(tx.is_backfill_assistant(role, body), F.substring(body, 1, 512)).alias("reply"),
        tx.marker_label(body, 70, reject_bad=False).alias("marker"))
    cards = rows.groupBy("session_id").agg(
        F.expr("min_by(ask, turn_index) FILTER (WHERE ask IS NOT NULL)").alias("ask"),
        F.expr("max_by(reply, turn_index) FILTER (WHERE reply IS NOT NULL)").alias("reply"),
        F.expr("max_by(marker, turn_index) FILTER (WHERE marker IS NOT NULL)").alias("marker"),
        F.count(F.lit(1)).alias("n_turns"))
    return cards.select(
        "session_id",
        F.substring(F.coalesce("ask", F.lit(sc.NO_USER_BACKFILL)), 1, 512).alias("query"),
        F.coalesce("marker", tx.backfill_title(F.col("ask"), F.lit(source))).alias("intent"),
        F.concat(F.lit("replay session "), "session_id", F.lit(" ("),
                 F.col("n_turns").cast("string"), F.lit(" turns)")).alias("step"),
        F.coalesce("reply", F.lit(sc.NO_ASSISTANT_BACKFILL)).alias("outcome"),
        F.lit(f"{source}-backfill").alias("task_type"), F.lit("private").alias("acl"),
        F.array(F.lit("backfill"), F.lit(f"src:{source}")).alias("tags"))


def task_summary_title(turns: DataFrame) -> DataFrame:
    """(session_id, title): label of the last turn whose marker line is usable."""
    return (turns.select("session_id", "turn_index", tx.marker_label(F.col("content")).alias("t"))
            .filter("t IS NOT NULL").groupBy("session_id")
            .agg(F.max_by("t", "turn_index").alias("title")))


def intents(cards: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Title of a card: task marker, else a supplied label, else the heuristic. ``labels`` is
    (session_id, label) as produced outside."""
    if labels is None:
        return cards
    tidy = labels.select("session_id", tx.clean_label(F.col("label")).alias("_label"))
    auto = tx.heuristic_title(F.col("query"))
    return (cards.join(tidy, "session_id", "left")
            .withColumn("intent", F.when(F.col("intent") == auto, F.coalesce("_label", "intent"))
                        .otherwise(F.col("intent"))).drop("_label"))


PIECES = 8


def turn_digest(role: Column, content: Column, tool_names: Column | None) -> Column:
    names = F.coalesce(F.array_join(tool_names, ","), F.lit("")) if tool_names is not None else F.lit("")
    return F.sha2(F.concat_ws("\u001f", role, tx.flatten_ws(F.coalesce(content, F.lit(""))), names), 256)


def fingerprint(turns: DataFrame) -> DataFrame:
    """(session_id, n_turns, fingerprint) over the ordered (role, normalised content, tool
    names); turn numbers, times and metadata do not count, only the order.

    Every turn is hashed where it is read. Only the hashes are placed in their order (dense
    positions over chunks), hashed with the position and added up in eight limbs: no content
    is shuffled and no session is collected.
    """
    names = F.transform("tool_calls", lambda c: c["name"]) if "tool_calls" in turns.columns else None
    h = turns.select("session_id", "turn_index", turn_digest(F.col("role"), F.col("content"), names).alias("_d"))
    h = running(h, ["session_id"], ["turn_index"], sums={"_at": F.lit(1)}).select(
        "session_id", F.sha2(F.concat_ws("\u001f", F.col("_at").cast("string"), "_d"), 256).alias("h"))
    limbs = [F.conv(F.substring("h", 1 + 7 * i, 7), 16, 10).cast("long") for i in range(PIECES)]
    agg = h.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        *[F.sum(e).alias(f"_l{i}") for i, e in enumerate(limbs)])
    return agg.select("session_id", "n_turns", F.sha2(F.concat_ws(
        "-", F.col("n_turns").cast("string"),
        *[F.col(f"_l{i}").cast("string") for i in range(PIECES)]), 256).alias("fingerprint"))


def session_stats(turns: DataFrame) -> DataFrame:
    return turns.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("turn_count"),
        F.sum(F.length(F.coalesce("content", F.lit("")))).alias("content_len"))
