"""Redaction by many rules: one pass over a text says which rules are worth trying.

``redact`` makes a branch of the query plan for every rule, which suits some dozens. Here rules are data, of
any number: all literals that the rules need are found together by one automaton (Aho-Corasick), and
only rules with a literal in the text, and those without literals whose probe is found, are applied, in the
rules' order. A rule that rewrites the text can call later ones in, so the text is then searched again.
Texts and counts equal those of ``redact`` with the same rules; the plan does not depend on their number.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import asdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.functions.rules import Rule

MOST = 100_000   # rules of a table: they go to every task
RULES = "pos long, name string, pattern string, placeholder string, severity string, needs array<string>, probe string"


def rules_table(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    rows = [(i, r.name, r.pattern, r.placeholder, r.severity, list(r.needs), r.probe) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, RULES)


def rules_of(table: DataFrame) -> tuple[Rule, ...]:
    """The rules of a table in their order; a table with more than ``MOST`` is refused."""
    rows = table.orderBy("pos", "name").limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"more than {MOST} rules")
    return tuple(Rule(r["name"], r["pattern"], r["placeholder"], r["severity"], tuple(r["needs"] or ()), r["probe"] or "") for r in rows)


class RuleSet:
    """Compiled rules and the automaton of their literals."""

    def __init__(self, rules: Iterable[Rule]):
        import ahocorasick

        self.rules = list(rules)
        # as in the engine's own expressions: classes and word borders are ASCII, $n is a group
        self.patterns = [re.compile(r.pattern, re.ASCII) for r in self.rules]
        self.places = [re.sub(r"\\?\$(\d)", lambda m: m[0] if m[0].startswith("\\") else rf"\g<{m[1]}>", r.placeholder.replace("\\", r"\\")) for r in self.rules]
        self.always = {i: re.compile(r.probe or r.pattern, re.ASCII) for i, r in enumerate(self.rules) if not r.needs}
        owners: dict[str, list[int]] = {}
        for i, r in enumerate(self.rules):
            for literal in r.needs:
                owners.setdefault(literal, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for literal, who in owners.items():
            self.automaton.add_word(literal, tuple(who))
        self.automaton.make_automaton()
        self.literals = bool(owners)

    def wanted(self, text: str) -> set[int]:
        found = {i for i, probe in self.always.items() if probe.search(text)}
        if self.literals:
            for _, who in self.automaton.iter(text):
                found.update(who)
        return found

    def __call__(self, text: str) -> tuple[str, dict[str, int]]:
        hits: dict[str, int] = {}
        todo, at = sorted(self.wanted(text)), -1
        while todo:
            at = todo.pop(0)
            text, n = self.patterns[at].subn(self.places[at], text)
            if n:
                name = self.rules[at].name
                hits[name] = hits.get(name, 0) + n
                todo = sorted(i for i in self.wanted(text) | set(todo) if i > at)
        return text, hits


def redact_by_table(df: DataFrame, col: str, rules: Iterable[Rule]) -> DataFrame:
    """Add ``<col>_redacted`` and ``redactions`` (name to count); a null text stays null without counts."""
    rules = [asdict(r) for r in rules]
    added = [T.StructField(f"{col}_redacted", T.StringType()), T.StructField("redactions", T.MapType(T.StringType(), T.LongType()))]
    kept = [f for f in df.schema.fields if f.name not in {a.name for a in added}]
    schema, at = T.StructType([*kept, *added]), [f.name for f in kept].index(col)

    def run(batches):
        rule_set = RuleSet(Rule(**r) for r in rules)
        for b in batches:
            texts, hits = [], []
            for text in b.column(at).to_pylist():
                out, n = (None, {}) if text is None else rule_set(text)
                texts.append(out)
                hits.append(list(n.items()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string()), pa.array(hits, pa.map_(pa.string(), pa.int64()))], schema.names)

    return df.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)
