"""Ordered redaction as one JVM-side column expression, plus the JSON tree form."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.functions.rules import DEFAULT_RULES, HIGH_CATEGORIES, SKIP_KEYS, Rule

HITS_TYPE = T.MapType(T.StringType(), T.LongType())
TREE_TYPE = T.StructType([T.StructField("json", T.StringType()), T.StructField("hits", HITS_TYPE)])


def sql_text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spell(pattern: str, unicode_boundary: bool) -> str:
    return ("(?U)" + pattern) if unicode_boundary else pattern


def _may_match(text: str, rule: Rule, unicode_boundary: bool) -> str:
    if rule.needs:
        return "(" + " OR ".join(f"contains({text}, {sql_text(n)})" for n in rule.needs) + ")"
    return f"({text} RLIKE {sql_text(_spell(rule.probe or rule.pattern, unicode_boundary))})"


@lru_cache(maxsize=64)
def _fold_sql(rules: tuple[Rule, ...], unicode_boundary: bool) -> str:
    """One fold over the rule numbers, as SQL text over the variable ``t``.

    The running text is evaluated once per rule and every pattern stays a literal, so it is
    compiled once per task. Flags say which rules can match the incoming text at all; once a
    rule has rewritten it, the flag is taken again. Text rather than Column calls because a
    few thousand of those cost more on the driver than the planning of the query.
    """
    probes = list(dict.fromkeys((r.needs, r.probe or r.pattern) for r in rules))
    by_probe = {(r.needs, r.probe or r.pattern): r for r in rules}
    cases = []
    for n, rule in enumerate(rules):
        pattern = sql_text(_spell(rule.pattern, unicode_boundary))
        flag = f"s.flags[{probes.index((rule.needs, rule.probe or rule.pattern))}]"
        again = f"(size(s.seen) > 0 AND {_may_match('s.text', rule, unicode_boundary)})"
        cases.append(
            f"WHEN {n} THEN CASE WHEN {flag} OR {again} THEN named_struct("
            f"'text', regexp_replace(s.text, {pattern}, {sql_text(rule.placeholder)}), "
            f"'seen', concat(s.seen, array(named_struct('name', '{rule.name}', "
            f"'n', CAST(regexp_count(s.text, {pattern}) AS BIGINT)))), 'flags', s.flags) ELSE s END")
    flags = ", ".join(_may_match("t", by_probe[p], unicode_boundary) for p in probes)
    start = ("named_struct('text', t, 'seen', CAST(array() AS array<struct<name:string,n:bigint>>), "
             f"'flags', array({flags}))")
    numbers = ", ".join(str(i) for i in range(len(rules)))
    return (f"aggregate(array({numbers}), {start}, (s, i) -> CASE i {' '.join(cases)} ELSE s END, "
            "s -> named_struct('text', s.text, 'hits', map_from_entries(filter(s.seen, e -> e.n > 0))))")


def redact(text: Column, rules: tuple[Rule, ...] = DEFAULT_RULES,
           unicode_boundary: bool = False) -> Column:
    """``STRUCT<text STRING, hits MAP<STRING,BIGINT>>``: every rule rewrites the text the
    previous rule left, and its hits are counted on that same text."""
    body = _fold_sql(tuple(rules), unicode_boundary)
    return F.call_function("transform", F.array(text), F.expr(f"t -> {body}")).getItem(0)


def redact_text(df: DataFrame, col: str, rules: tuple[Rule, ...] = DEFAULT_RULES,
                unicode_boundary: bool = False) -> DataFrame:
    """Add ``<col>_redacted`` and ``redactions``."""
    out = df.withColumn("_r", redact(F.col(col), rules, unicode_boundary))
    return (out.withColumn(f"{col}_redacted", F.col("_r.text"))
               .withColumn("redactions", F.col("_r.hits")).drop("_r"))


def redact_scope(df: DataFrame, cols: list[str], rules: tuple[Rule, ...] = DEFAULT_RULES) -> DataFrame:
    """Redact several string columns in place; ``redactions`` sums their hits."""
    for c in cols:
        df = df.withColumn(f"_r_{c}", redact(F.coalesce(F.col(c), F.lit("")), rules))
    hit_maps = [F.col(f"_r_{c}.hits") for c in cols]
    merged = reduce(merge_hits, hit_maps)
    keep = [F.col(f"_r_{c}.text").alias(c) if c in cols else F.col(c)
            for c in df.columns if not c.startswith("_r_")]
    return df.select(*keep, merged.alias("redactions"))


def merge_hits(a: Column, b: Column) -> Column:
    return F.map_zip_with(a, b, lambda _k, x, y: F.coalesce(x, F.lit(0).cast("long"))
                          + F.coalesce(y, F.lit(0).cast("long")))


def has_high_severity(hits: Column, high: tuple[str, ...] = HIGH_CATEGORIES) -> Column:
    return F.coalesce(
        F.exists(F.map_entries(hits),
                 lambda e: e["key"].isin(*high) & (e["value"] > 0)), F.lit(False))


def hit_sums(hits: str, rules: tuple[Rule, ...] = DEFAULT_RULES) -> Column:
    """Aggregate: sum of a hit map column as one map, by fixed per-category sums (one pass,
    partial aggregation on the map side, no explode and no second shuffle)."""
    cells = ", ".join(f"'{r.name}', coalesce(sum({hits}['{r.name}']), CAST(0 AS BIGINT))" for r in rules)
    return F.expr(f"map_filter(map({cells}), (k, v) -> v > 0)")


def rule_hit_report(df: DataFrame, hits: str, rules: tuple[Rule, ...] = DEFAULT_RULES) -> DataFrame:
    """(category, hits, n_texts) over a corpus, in one pass: per-rule sums and counts, laid
    out as rows only after the aggregation."""
    cells = ", ".join(
        f"named_struct('category', '{r.name}', 'hits', coalesce(sum({hits}['{r.name}']), CAST(0 AS BIGINT)), "
        f"'n_texts', count({hits}['{r.name}']))" for r in rules)
    return (df.agg(F.expr(f"array({cells})").alias("c")).select(F.explode("c").alias("c"))
            .select("c.*").filter("n_texts > 0"))


def mask_cards(text: Column) -> Column:
    """Runs of 13-19 digits (single spaces or hyphens allowed) become ``<CARD>`` when the
    Luhn check passes; ``STRUCT<text, hits BIGINT>``."""
    runs = F.regexp_extract_all(text, F.lit(r"\b(?:\d[ \-]?){12,18}\d\b"), 0)
    valid = F.filter(runs, lambda r: F.call_function(
        "luhn_check", F.regexp_replace(r, r"[^0-9]", "")))
    good, hits = F.array_distinct(valid), F.size(valid)
    # longest first, so that a run inside a longer one never breaks it
    ordered = F.reverse(F.array_sort(F.transform(
        good, lambda r: F.struct(F.length(r).alias("n"), r.alias("r")))))
    masked = F.aggregate(ordered, text, lambda acc, r: F.regexp_replace(
        acc, F.concat(F.lit(r"\b"), r["r"], F.lit(r"\b")), F.lit("<CARD>")))
    guard = F.rlike(text, F.lit(r"\d[ \-]?\d[ \-]?\d[ \-]?\d[ \-]?\d[ \-]?\d[ \-]?\d[ \-]?\d"))
    return F.when(guard, F.struct(masked.alias("text"), hits.cast("long").alias("hits"))).otherwise(
        F.struct(text.alias("text"), F.lit(0).cast("long").alias("hits")))


# --- JSON trees: Catalyst has no recursive map over a variant, so an Arrow UDF walks it ---

def _scrub(text: str, rules, hits: dict[str, int]) -> str:
    for name, pattern, placeholder in rules:
        text, n = pattern.subn(placeholder, text)
        if n:
            hits[name] = hits.get(name, 0) + n
    return text


def _walk(node, rules, hits):
    if isinstance(node, str):
        return _scrub(node, rules, hits)
    if isinstance(node, list):
        return [_walk(x, rules, hits) for x in node]
    if isinstance(node, dict):
        return {k: v if k in SKIP_KEYS else _walk(v, rules, hits) for k, v in node.items()}
    return node


def redact_tree(rules: tuple[Rule, ...] = DEFAULT_RULES):
    """Arrow UDF over a JSON string column: ``STRUCT<json STRING, hits MAP>``."""
    specs = [(r.name, r.pattern, re.sub(r"\$(\d)", r"\\\1", r.placeholder)) for r in rules]

    @F.pandas_udf(TREE_TYPE)
    def walk(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compiled = [(n, re.compile(p), s) for n, p, s in specs]
        for batch in batches:
            texts, counts = [], []
            for raw in batch:
                hits: dict[str, int] = {}
                if raw is None:
                    texts.append(None)
                else:
                    try:
                        tree = _walk(json.loads(raw), compiled, hits)
                        texts.append(json.dumps(tree, ensure_ascii=False, separators=(",", ":")))
                    except (ValueError, RecursionError):  # no JSON, or nested too deep to walk
                        texts.append(_scrub(raw, compiled, hits))
                counts.append(hits)
            yield pd.DataFrame({"json": texts, "hits": counts})

    return walk


def register_sql(spark, rules: tuple[Rule, ...] = DEFAULT_RULES) -> None:
    """SQL surface: ``redact(text)`` as a JVM-side SQL function and ``redact_tree(json)``."""
    body = _fold_sql(tuple(rules), False)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION redact(txt STRING) "
              "RETURNS STRUCT<text: STRING, hits: MAP<STRING, BIGINT>> "
              f"RETURN transform(array(txt), t -> {body})[0]")
    spark.udf.register("redact_tree", redact_tree(rules))


def leak_check(df: DataFrame, cols: list[str], rules: tuple[Rule, ...] = DEFAULT_RULES) -> DataFrame:
    """Rows of (column, rule, n) for every rule that still changes a stored string."""
    probe = df.select(*[redact(F.coalesce(F.col(c), F.lit("")), rules).alias(c) for c in cols])
    per_col = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}.hits").alias("hits"))
                        for c in cols])
    return (probe.select(F.explode(per_col).alias("p"))
            .select("p.column", F.explode("p.hits").alias("rule", "n"))
            .groupBy("column", "rule").agg(F.sum("n").alias("n")))
