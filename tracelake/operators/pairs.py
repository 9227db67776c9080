"""Evaluable turn pairs, their context and prompts, transcripts, task segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions import text as tx
from tracelake.operators.scan import running
from tracelake.session import materialize

# Clip lengths of a packed transcript and the text of its lines.
PACK_USER, PACK_ASSISTANT, PACK_TOOL = 600, 600, 120
LINE_USER, LINE_ASSISTANT, LINE_CALLS, LINE_TOOL = "[用户] ", "[助手] ", "[助手→工具] ", "[工具结果] "
TRUNCATED = "...(truncated)"
NO_FOLLOW_UP = "(no follow-up turns)"
CONTEXT_CHUNK = 16_384


def _calls(turns: DataFrame) -> Column:
    if "tool_calls" in turns.columns:
        return F.coalesce(F.size("tool_calls"), F.lit(0))
    return F.lit(0)


def evaluable_pairs(turns: DataFrame) -> DataFrame:
    """(session_id, user_idx, assistant_idx, pair_no, n_pairs).

    A user turn is answered by the first assistant turn after it, and the latest non-blank
    user turn counts. The turns are read once, down to roles and a blank flag; that narrow
    table is stored, since the running values below read it several times.
    """
    marks = turns.select(
        "session_id", "turn_index",
        ((F.col("role") == "user") & ~tx.is_blank(F.col("content"))).alias("asks"),
        (F.col("role") == "assistant").alias("answers")).filter("asks OR answers")
    marks = materialize(marks, "marks")
    seen = running(marks, ["session_id"], ["turn_index"], lasts={
        "user_idx": F.when(F.col("asks"), F.col("turn_index")),
        "prev_answer": F.when(F.col("answers"), F.col("turn_index"))})
    pairs = seen.filter(
        F.col("answers") & F.col("user_idx").isNotNull()
        & (F.col("prev_answer").isNull() | (F.col("prev_answer") < F.col("user_idx")))
    ).select("session_id", "user_idx", F.col("turn_index").alias("assistant_idx"))
    return running(pairs, ["session_id"], ["assistant_idx"], sums={"pair_no": F.lit(1)},
                   totals={"n_pairs": "pair_no"}, inclusive=True)


def select_turns_first(pairs: DataFrame, max_turns: int = 8) -> DataFrame:
    return pairs.filter(F.col("pair_no") <= max_turns)


def select_turns_even(pairs: DataFrame, max_turns: int = 8) -> DataFrame:
    """Evenly spaced pairs, first and last included; a row decides for itself from its
    number and the count of its session."""
    if max_turns <= 1:
        return select_turns_first(pairs, max_turns)
    n = F.col("n_pairs")
    step = (n - 1).cast("double") / F.lit(float(max_turns - 1))
    spots = F.transform(F.sequence(F.lit(0), F.lit(max_turns - 1)),
                        lambda i: F.rint(i.cast("double") * step).cast("long"))
    wanted = F.slice(F.array_sort(F.array_distinct(F.concat(
        spots, F.array(F.lit(0).cast("long"), n - 1)))), 1, max_turns)
    return pairs.filter((n <= max_turns) | F.array_contains(wanted, F.col("pair_no") - 1))


def select_turns_important(pairs: DataFrame, max_turns: int = 8) -> DataFrame:
    """Scores are all equal at this point, so the even choice is what this name means."""
    return select_turns_even(pairs, max_turns)


def select_turns_ranked(turns: DataFrame, pairs: DataFrame, max_turns: int = 8) -> DataFrame:
    """Most tool calls first, then the longest answer; ties by position. The rank filter is
    applied per map task before the shuffle (a top-n per session is all that travels)."""
    size = turns.filter(F.col("role") == "assistant").select(
        "session_id", F.col("turn_index").alias("assistant_idx"),
        _calls(turns).cast("long").alias("n_calls"), F.length(F.coalesce("content", F.lit(""))).cast("long").alias("n_chars"))
    w = Window.partitionBy("session_id").orderBy(
        F.desc("n_calls"), F.desc("n_chars"), "assistant_idx")
    return (pairs.join(size, ["session_id", "assistant_idx"])
            .withColumn("rank_no", F.row_number().over(w)).filter(F.col("rank_no") <= max_turns)
            .withColumn("rank_no", F.col("rank_no").cast("long")))


def subsequent_context(turns: DataFrame, pairs: DataFrame, k: int = 4,
                       max_chars: int = 800) -> DataFrame:
    """Pairs with ``subsequent``: the next ``k`` user or assistant turns that say something.

    Eligible turns get a running number; a turn needs the numbers right after its own. The
    window runs over blocks of that number, and each block also gets a copy of the first
    ``k`` turns of the next one, so no task ever holds a whole session.
    """
    if k > CONTEXT_CHUNK:
        raise ValueError(f"at most {CONTEXT_CHUNK} following turns")
    role = F.col("role")
    body = F.substring(F.coalesce("content", F.lit("")), 1, max_chars)
    calls = _calls(turns)
    says = role.isin("user", "assistant") & (~tx.is_blank(body) | (calls > 0))
    tool_calls = F.col("tool_calls") if "tool_calls" in turns.columns else None
    line = F.when(says, F.when(role == "user", F.concat(F.lit("User: "), body)).otherwise(
        F.concat(F.lit("Assistant: "), F.substring(
            tx.format_assistant(body, tool_calls), 1, max_chars))))
    rows = turns.filter(role.isin("user", "assistant")).select(
        "session_id", "turn_index", line.alias("line"),
        F.when(says, 1).otherwise(0).alias("eligible"), (role == "assistant").alias("answers"))
    numbered = running(rows, ["session_id"], ["turn_index"], sums={"no": F.col("eligible")},
                       inclusive=True)
    block = F.floor(F.col("no") / F.lit(CONTEXT_CHUNK))
    halo = ((F.col("eligible") == 1) & (F.col("no") >= CONTEXT_CHUNK)
            & (F.col("no") % CONTEXT_CHUNK < k))
    homes = F.when(halo, F.array(block, block - 1)).otherwise(F.array(block))
    placed = numbered.select("*", F.posexplode(homes).alias("copy", "block"))
    w = (Window.partitionBy("session_id", "block").orderBy("no").rangeBetween(1, k))
    after = F.collect_list(F.when(F.col("eligible") == 1, F.struct("no", "line"))).over(w)
    context = (placed.withColumn("after", after)
               .filter((F.col("copy") == 0) & F.col("answers"))
               .select("session_id", F.col("turn_index").alias("assistant_idx"),
                       F.array_join(F.transform(F.array_sort("after"), lambda a: a["line"]),
                                    "\n\n").alias("subsequent")))
    return pairs.join(context, ["session_id", "assistant_idx"])


def judge_input(turns: DataFrame, pairs: DataFrame, k: int = 4) -> DataFrame:
    """Pairs with ``prompt``: the request, the answer and what came next."""
    ask = turns.filter(F.col("role") == "user").select(
        "session_id", F.col("turn_index").alias("user_idx"),
        tx.strip(F.coalesce("content", F.lit(""))).alias("_ask"))
    calls = F.col("tool_calls") if "tool_calls" in turns.columns else None
    reply = turns.filter(F.col("role") == "assistant").select(
        "session_id", F.col("turn_index").alias("assistant_idx"),
        tx.format_assistant(F.col("content"), calls).alias("_reply"))
    ctx = (subsequent_context(turns, pairs, k)
           .join(reply, ["session_id", "assistant_idx"]).join(ask, ["session_id", "user_idx"]))
    later = F.when(F.col("subsequent") == "", NO_FOLLOW_UP).otherwise(F.col("subsequent"))
    return ctx.withColumn("prompt", F.concat(
        F.lit("<user>\n"), "_ask", F.lit("\n</user>\n\n<assistant>\n"), "_reply",
        F.lit("\n</assistant>\n\n<subsequent>\n"), later, F.lit("\n</subsequent>"))
    ).drop("_ask", "_reply")


def transcript_line(turns: DataFrame) -> Column:
    content = tx.strip(F.coalesce(F.col("content"), F.lit("")))
    role = F.col("role")
    said = F.when(content != "", F.concat(F.lit(LINE_ASSISTANT), F.substring(content, 1, PACK_ASSISTANT)))
    if "tool_calls" in turns.columns:
        names = F.array_join(F.transform("tool_calls", lambda c: F.coalesce(c["name"], F.lit("?"))), ", ")
        said = F.when(F.size("tool_calls") > 0, F.concat(F.lit(LINE_CALLS), names)).otherwise(said)
    tool = F.concat(F.lit(LINE_TOOL), F.replace(F.substring(content, 1, PACK_TOOL), F.lit("\n"), F.lit(" ")),
                    F.when(F.length(content) > PACK_TOOL, F.lit("…")).otherwise(F.lit("")))
    return (F.when((role == "user") & (content != ""),
                   F.concat(F.lit(LINE_USER), F.substring(content, 1, PACK_USER)))
             .when(role == "assistant", said).when((role == "tool") & (content != ""), tool))


def pack_transcript(turns: DataFrame, max_chars: int = 6000) -> DataFrame:
    """(session_id, transcript): lines in order while they fit the budget, then a mark.

    Lines are clipped before the shuffle. A line is kept when the running length before it
    plus its own fits; once one does not fit the running length only grows, so the cut is
    the first such line and about ``max_chars`` characters per session are collected.
    """
    lines = turns.select("session_id", "turn_index", transcript_line(turns).alias("line")).filter(
        "line IS NOT NULL")
    used = running(lines, ["session_id"], ["turn_index"], sums={"used": F.length("line") + 1})
    near = used.filter(F.col("used") <= max_chars + 1).withColumn(
        "over", F.col("used") + F.length("line") > max_chars)
    packed = near.groupBy("session_id").agg(
        F.array_sort(F.collect_list(F.struct("turn_index", "line", "over"))).alias("l"))
    first_over = F.expr("array_position(transform(l, x -> x.over), true)").cast("int")
    text = F.when(first_over > 0, F.concat(
        F.slice(F.transform("l", lambda x: x["line"]), F.lit(1), first_over - 1),
        F.array(F.lit(TRUNCATED)))).otherwise(F.transform("l", lambda x: x["line"]))
    return packed.select("session_id", F.array_join(text, "\n").alias("transcript"))


def segment_tasks(turns: DataFrame) -> DataFrame:
    """Turns with ``segment_id`` (a marker line ends its segment) and ``marker``."""
    rows = turns.withColumn("marker", tx.marker_label(F.col("content"), reject_bad=False))
    return running(rows, ["session_id"], ["turn_index"],
                   sums={"segment_id": F.when(F.col("marker").isNotNull(), 1).otherwise(0)})


def segment_titles(segments: DataFrame) -> DataFrame:
    return segments.groupBy("session_id", "segment_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.min("turn_index").alias("first_turn"),
        F.max("marker").alias("title"))
