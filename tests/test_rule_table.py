"""Many rules as data against the fold, and against every rule tried in turn."""

import random
import re

from pyspark.sql import functions as F

from tests.test_redaction import HITS
from tracelake.functions import redact as rd
from tracelake.functions import rule_table as rt
from tracelake.functions.rules import DEFAULT_RULES, Rule, custom_rule, employee_id_rule, internal_host_rule


def many(n=500):
    rng = random.Random(n)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(2, 5))) for _ in range(n)]
    return tuple(Rule(f"r{i}", rf"\b{w}(\d?)\b", rf"<{rng.choice(words)}$1>", "low", (w,)) for i, w in enumerate(words))


def plain(text, rules):
    hits = {}
    for r in rules:
        text, n = re.compile(r.pattern, re.ASCII).subn(lambda m, r=r: re.sub(r"\$(\d)", lambda g: m[int(g[1])], r.placeholder), text)
        if n:
            hits[r.name] = hits.get(r.name, 0) + n
    return text, hits


def texts(rules, n=60):
    rng = random.Random(7)
    words = [r.needs[0] for r in rules if r.needs]
    return [" ".join(rng.choice(words) + rng.choice(["", "", "1", "x"]) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_five_hundred_rules_that_call_each_other(spark):
    rules = many()
    rows = [(i, t) for i, t in enumerate(texts(rules))] + [(900, ""), (901, None)]
    got = rt.redact_by_table(spark.createDataFrame(rows, "id long, t string"), "t", rules).collect()
    for r in got:
        assert (r["t_redacted"], r["redactions"]) == ((None, {}) if r["t"] is None else plain(r["t"], rules))
    assert sum(len(r["redactions"]) for r in got) > 300


def test_same_as_the_fold(spark):
    rules = (*DEFAULT_RULES, internal_host_rule(["corp.example"]), employee_id_rule(["E-"]), custom_rule("money", r"(\d+) (EUR|USD)", r"\2 \1", "low"))
    rows = [(i, f"{v} and {v} at GIT.corp.example or E-12345, 15 EUR\n{k}") for i, (k, v) in enumerate(HITS.items())]
    rows += [(10_000 + r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    df = spark.createDataFrame(rows, "id long, t string")
    want = {r["id"]: (r["t_redacted"], r["redactions"]) for r in rd.redact_text(df, "t", rules).collect()}
    got = {r["id"]: (r["t_redacted"], r["redactions"]) for r in rt.redact_by_table(df, "t", rules).collect()}
    assert got == want


def test_the_plan_does_not_grow_with_the_rules(spark):
    df = spark.createDataFrame([(1, "abcd")], "id long, t string")
    size = [len(rt.redact_by_table(df, "t", many(n))._jdf.queryExecution().toString()) for n in (10, 1000)]
    assert abs(size[0] - size[1]) < 200


def test_rules_keep_their_order_in_a_table(spark):
    rules = (Rule("b", "x", "y", "low", ("x",)), Rule("a", "y", "z", "low", ("y",)), Rule("c", r"\d+", "#", "low"))
    table = rt.rules_table(spark, rules).orderBy(F.desc("pos"))
    assert rt.rules_of(table) == rules
    assert rt.RuleSet(rt.rules_of(table))("x 1") == ("z #", {"b": 1, "a": 1, "c": 1})
