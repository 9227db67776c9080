"""Judge replies to rewards, summaries, upserts."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.functions.text import pipe, strip
from tracelake.schema import REWARD_DIMS

# Weight of each dimension in the trajectory score.
WEIGHTS = {"outcome": 0.35, "intent": 0.20, "execution": 0.20, "orchestration": 0.10,
           "expression": 0.15}
KEY = ("experience_id", "turn_index", "judge_model")
REPLY_FIELDS = [*REWARD_DIMS, "confidence", "reason"]


def parse_judge_reply(raw: Column) -> Column:
    """JSON object text inside a reply, or NULL: fenced or surrounded by prose is fine."""
    def unfence(text: Column) -> Column:
        inner = F.regexp_replace(F.try_element_at(F.split(text, "```", 3), F.lit(2)), r"\Ajson", "")
        return F.when(F.startswith(text, F.lit("```")), inner).otherwise(text)

    return pipe(raw, strip, unfence, lambda t: F.regexp_extract(t, r"(?s)\{.*\}", 0),
                # inside brackets, so that anything after the object makes the text invalid
                lambda o: F.when((o != "") & F.try_parse_json(F.concat(F.lit("["), o, F.lit("]"))).isNotNull(), o))


def reward_struct(obj: Column) -> Column:
    """The validated reward out of a JSON object text. Numbers are cut towards zero, texts
    must be whole numbers, anything else counts as 0; then values are clamped."""
    schema = ", ".join(f"{n} string" for n in REPLY_FIELDS)

    def read(o: Column) -> Column:
        kinds = F.try_parse_json(o)
        return F.struct(F.from_json(o, schema).alias("f"), *[
            F.schema_of_variant(F.try_variant_get(kinds, f"$.{d}", "variant")).alias(d)
            for d in (*REWARD_DIMS, "confidence")])

    def check(x: Column) -> Column:
        out = []
        for d in REWARD_DIMS:
            raw, kind = x["f"][d], x[d]
            value = (F.when(kind == "STRING", F.trim(raw).try_cast("long"))
                      .when(kind == "BOOLEAN", F.when(raw == "true", 1).otherwise(0))
                      .otherwise(raw.try_cast("double").try_cast("long")))
            out.append(F.greatest(F.lit(-1), F.least(F.lit(1), F.coalesce(value, F.lit(0))))
                       .cast("int").alias(d))
        raw = x["f"]["confidence"]
        conf = F.coalesce(F.when(x["confidence"] == "BOOLEAN", F.when(raw == "true", 1.0).otherwise(0.0)).otherwise(raw.try_cast("double")), F.lit(0.5))
        return F.struct(
            *out, F.greatest(F.lit(0.0), F.least(F.lit(1.0), conf)).alias("confidence"),
            F.substring(F.coalesce(x["f"]["reason"], F.lit("")), 1, 500).alias("reason"))

    return pipe(obj, read, check)


def validate_reward(replies: DataFrame, raw: str = "raw") -> tuple[DataFrame, DataFrame]:
    """(rewards, failures) of a reply table; the other columns are kept."""
    keep = [c for c in replies.columns if c != raw]
    parsed = replies.withColumn("_obj", parse_judge_reply(F.col(raw)))
    empty = F.regexp_replace("_obj", r"\s", "") == "{}"
    ok = F.col("_obj").isNotNull() & ~F.coalesce(empty, F.lit(True))
    rewards = (parsed.filter(ok).select(*keep, reward_struct(F.col("_obj")).alias("_r"))
               .select(*keep, "_r.*"))
    failures = parsed.filter(~ok).select(
        *keep, F.lit("non-json response").alias("error"), F.substring(F.coalesce(raw, F.lit("")), 1, 200).alias("raw"))
    return rewards, failures


def reward_failures(failures: DataFrame) -> DataFrame:
    kind = F.substring_index("error", ":", 1)
    return failures.groupBy(kind.alias("error")).agg(F.count(F.lit(1)).alias("n"))


def _mean3(c: str) -> Column:
    return F.bround(F.sum(c).cast("double") / F.count(F.lit(1)), 3) + F.lit(0.0)


def reward_summary(rewards: DataFrame, key: str = "experience_id") -> DataFrame:
    """Per trajectory: means, weighted score of the rounded means, mean confidence."""
    means = rewards.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), *[_mean3(d).alias(f"mean_{d}") for d in REWARD_DIMS],
        F.bround(F.avg("confidence"), 3).alias("confidence_mean"))
    score = reduce(add, [F.col(f"mean_{d}") * F.lit(w) for d, w in WEIGHTS.items()])
    return means.withColumn("trajectory_score", F.bround(score, 3) + F.lit(0.0))


def reward_upsert(old: DataFrame, new: DataFrame, key: tuple[str, ...] = KEY,
                  order: str = "arrival") -> DataFrame:
    """Latest row per key, by one aggregation that combines on the map side."""
    both = old.unionByName(new, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in key and c != order]
    return (both.groupBy(*key).agg(F.max(F.struct(order, *rest)).alias("_r"))
            .select(*key, "_r.*"))


def reward_join(experiences: DataFrame, rewards: DataFrame, judge_model: str | None = None) -> DataFrame:
    chosen = rewards if judge_model is None else rewards.filter(F.col("judge_model") == judge_model)
    return experiences.join(chosen, "experience_id", "left")


def judge_agreement(rewards: DataFrame, dim: str = "outcome") -> DataFrame:
    """Every pair of judges on the turns both scored: (judge_a, judge_b, n, same, mean_gap).

    Turns with the same scores by the same judges are counted together first, so pairs are
    made from the few distinct score patterns and not from the turns.
    """
    per_turn = rewards.groupBy("experience_id", "turn_index").agg(
        F.array_sort(F.collect_set(F.struct("judge_model", dim))).alias("j"))
    patterns = per_turn.groupBy("j").agg(F.count(F.lit(1)).alias("w"))
    pairs = F.flatten(F.transform("j", lambda a: F.transform(
        F.filter("j", lambda b: b["judge_model"] > a["judge_model"]),
        lambda b: F.struct(a["judge_model"].alias("judge_a"), b["judge_model"].alias("judge_b"),
                           (a[dim] - b[dim]).alias("gap")))))
    w = F.col("w")
    return (patterns.select("w", F.explode(pairs).alias("p")).groupBy("p.judge_a", "p.judge_b").agg(
        F.sum(w).alias("n"), F.sum(F.when(F.col("p.gap") == 0, w).otherwise(0)).alias("same"),
        F.bround(F.sum(F.abs("p.gap") * w).cast("double") / F.sum(w), 6).alias("mean_gap")))
