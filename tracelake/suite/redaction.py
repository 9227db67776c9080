"""Redaction, counts, routing and strict-public audit on the given texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.functions import redact as rd
from tracelake.functions import rule_table
from tracelake.functions.rules import (
    DEFAULT_RULES, HIGH_CATEGORIES, Rule, custom_rule, employee_id_rule, internal_host_rule,
)
from tracelake.operators import cards as cd
from tracelake.operators import governance as gv
from tracelake.suite.cards import CLEAN_SQL, SUMS
from tracelake.suite.registry import (
    case, hits_text, hits_text_sql, q, rule_steps, spread, table, turns, turns_cte,
)

DOCS = f"WITH {rule_steps('documents', 'text', keep='doc_id, source')}"
HIGH = " + ".join(f"h_{n}" for n in HIGH_CATEGORIES)


def docs(spark, sf):
    return rd.redact_text(spread(table(spark, sf, "documents").select("doc_id", "source", "text")), "text")


@case("redact_text", f"{DOCS} SELECT doc_id, txt AS text_redacted FROM r")
def redact_text(spark, sf):
    return docs(spark, sf).select("doc_id", "text_redacted")


@case("redaction_counts", f"{DOCS} SELECT doc_id, {hits_text_sql()} AS redactions FROM r")
def redaction_counts(spark, sf):
    return docs(spark, sf).select("doc_id", hits_text("redactions").alias("redactions"))


@case("redaction_totals", f"WITH {CLEAN_SQL}, a AS (SELECT session_id, {SUMS} FROM clean GROUP BY session_id) "
                          f"SELECT session_id, {hits_text_sql()} AS redactions FROM a")
def redaction_totals(spark, sf):
    clean = cd.redact_turns(turns(spark, sf))
    return (clean.groupBy("session_id").agg(rd.hit_sums("redactions").alias("m"))
            .select("session_id", hits_text("m").alias("redactions")))


@case("redact_tree", f"WITH {turns_cte()}, {rule_steps('turns', 'tool_cmd', tag='t', keep='session_id, turn_index, call_id')} "
                     f"SELECT session_id, turn_index, concat('{{\"id\":\"/home/user/x/\",\"args\":[{{\"cmd\":\"', txt, '\",\"n\":1}}]}}') AS json, "
                     f"{hits_text_sql()} AS hits FROM t WHERE call_id <> ''")
def redact_tree(spark, sf):
    t = turns(spark, sf).filter(F.size("tool_calls") > 0)
    nested = F.concat(F.lit('{"id":"/home/user/x/","args":['), F.get("tool_calls", 0)["input"], F.lit("]}"))
    return t.select("session_id", "turn_index", rd.redact_tree()(nested).alias("r")).select(
        "session_id", "turn_index", "r.json", hits_text("r.hits").alias("hits"))


@case("has_high_severity", f"{DOCS} SELECT doc_id, ({HIGH}) > 0 AS high FROM r")
def has_high_severity(spark, sf):
    return docs(spark, sf).select("doc_id", rd.has_high_severity(F.col("redactions")).alias("high"))


SCOPE_SUMS = ", ".join(f"r.h_{x.name} + u.h_{x.name} AS h_{x.name}" for x in DEFAULT_RULES)
PAGE_URL = "concat(url, '?from=192.0.2.', CAST(page_id % 250 AS STRING))"


@case("redact_scope", f"""WITH {rule_steps('pages', 'html', keep='page_id')}, {rule_steps('pages', PAGE_URL, tag='u', keep='page_id AS pid')},
 b AS (SELECT page_id, r.txt AS html, u.txt AS url, {SCOPE_SUMS} FROM r JOIN u ON page_id = pid)
 SELECT page_id, html, url, {hits_text_sql()} AS redactions FROM b""")
def redact_scope(spark, sf):
    pages = spread(table(spark, sf, "pages")).select("page_id", F.expr(PAGE_URL).alias("url"), "html")
    out = rd.redact_scope(pages, ["url", "html"])
    return out.withColumn("redactions", hits_text("redactions"))


CARD_NUMBER = "CASE doc_id % 3 WHEN 0 THEN ' card 4111 1111 1111 1111 end' WHEN 1 THEN ' card 4111-1111-1111-1112 end' ELSE ' id 79927398713 end' END"


@case("credit_card_luhn", f"""WITH b AS (SELECT doc_id, concat(text, {CARD_NUMBER}) AS t FROM documents),
 runs AS (SELECT doc_id, unnest(regexp_extract_all(t, '\\b(?:\\d[ \\-]?){{12,18}}\\d\\b')) AS run FROM b),
 digits AS (SELECT doc_id, run, regexp_replace(run, '[^0-9]', '', 'g') AS d FROM runs),
 sums AS (SELECT doc_id, run, (SELECT sum(CASE WHEN (length(d) - i) % 2 = 1 THEN
     (CASE WHEN CAST(substring(d, i, 1) AS INT) > 4 THEN CAST(substring(d, i, 1) AS INT) * 2 - 9 ELSE CAST(substring(d, i, 1) AS INT) * 2 END)
     ELSE CAST(substring(d, i, 1) AS INT) END) FROM (SELECT unnest(range(1, length(d) + 1)) AS i)) % 10 AS s FROM digits),
 good AS (SELECT doc_id, count(*) AS n, list(DISTINCT run) AS runs FROM sums WHERE s = 0 GROUP BY doc_id)
 SELECT b.doc_id, coalesce(n, 0) AS hits, coalesce(list_reduce(list_prepend(t, list_sort(runs)), lambda a, x: replace(a, x, '<CARD>')), t) AS masked
 FROM b LEFT JOIN good USING (doc_id)""")
def credit_card_luhn(spark, sf):
    d = spread(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", F.concat("text", F.expr(CARD_NUMBER)).alias("t"))
    return d.select("doc_id", rd.mask_cards(F.col("t")).alias("m")).select("doc_id", "m.hits", F.col("m.text").alias("masked"))


HOST = internal_host_rule(["example.net", "corp.example.com"])
STAFF = employee_id_rule(["EMP", "STAFF"])
TOKEN = custom_rule("hex_token", r'\btoken = "[0-9a-f]{40}"', "token = <SECRET>", "high")
HOST_TEXT = ("concat(text, ' host build', CAST(doc_id % 9 AS STRING), '.corp.example.com, WWW.Example.NET. or example.org, not my-example.net, corp.example.com.evil.org, "
             "xcorp.example.com nor example.net-x; http://a.b.example.net/corp.example.com:80')")
# the same without look-around: every run of host characters is judged as a whole
HOST_RUN = r"(?i)^((?:[a-z0-9-]+\.)*(?:corp\.example\.com|example\.net))(\.(?:[^a-z0-9].*)?)?$"
HOST_RUNS = f"regexp_extract_all({HOST_TEXT}, '[A-Za-z0-9.-]+|[^A-Za-z0-9.-]+')"
HOST_SQL = (f"SELECT doc_id, array_to_string(list_transform({HOST_RUNS}, lambda x: regexp_replace(x, {q(HOST_RUN)}, '<INTERNAL_HOST>\\2')), '') AS masked, "
            f"CAST(len(list_filter({HOST_RUNS}, lambda x: regexp_matches(x, {q(HOST_RUN)}))) AS BIGINT) AS hits FROM documents")
STAFF_TEXT = "concat(text, ' by EMP', CAST(1000 + doc_id AS STRING), ' STAFF12 EMP', CAST(doc_id % 10 AS STRING))"


def one_rule(rule, text):
    return (f"SELECT doc_id, regexp_replace({text}, {q(rule.pattern)}, {q(rule.placeholder)}, 'g') AS masked, "
            f"CAST(len(regexp_extract_all({text}, {q(rule.pattern)})) AS BIGINT) AS hits FROM documents")


def apply_rule(spark, sf, rule, text):
    d = spread(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", F.expr(text).alias("t"))
    return d.select("doc_id", rd.redact(F.col("t"), (rule,)).alias("r")).select(
        "doc_id", F.col("r.text").alias("masked"), F.coalesce(F.col("r.hits")[rule.name], F.lit(0).cast("long")).alias("hits"))


@case("internal_host_mask", HOST_SQL)
def internal_host_mask(spark, sf):
    return apply_rule(spark, sf, HOST, HOST_TEXT)


@case("employee_id_mask", one_rule(STAFF, STAFF_TEXT))
def employee_id_mask(spark, sf):
    return apply_rule(spark, sf, STAFF, STAFF_TEXT)


@case("custom_rules", one_rule(TOKEN, "text"))
def custom_rules(spark, sf):
    return apply_rule(spark, sf, TOKEN, "text")


@case("rule_hit_report", f"{DOCS}, long AS (" + " UNION ALL ".join(
    f"SELECT '{r.name}' AS category, h_{r.name} AS n FROM r" for r in DEFAULT_RULES)
    + ") SELECT category, CAST(sum(n) AS BIGINT) AS hits, count(*) AS n_texts FROM long WHERE n > 0 GROUP BY category")
def rule_hit_report(spark, sf):
    return rd.rule_hit_report(docs(spark, sf), "redactions")


@case("review_routing", f"""{DOCS} SELECT doc_id, CASE WHEN {HIGH} > 0 THEN 'pending' ELSE 'auto_approved' END AS review_status,
  CASE WHEN {HIGH} = 0 OR toxic IS NULL THEN 'layer1_only' WHEN toxic = 1 THEN 'human_review' ELSE 'flagged' END AS sanitization_status
  FROM r LEFT JOIN labels USING (doc_id)""".replace("'text'", "'text'").replace(
    "documents)", "(SELECT doc_id, source, concat(text, CASE WHEN doc_id % 5 = 0 THEN ' password = Zq100000000000000x' ELSE '' END) AS text FROM documents))", 1))
def review_routing(spark, sf):
    d = spread(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", F.expr(
        "concat(text, CASE WHEN doc_id % 5 = 0 THEN ' password = Zq100000000000000x' ELSE '' END)").alias("text"))
    cards = d.select("doc_id", rd.redact(F.col("text")).alias("r")).select("doc_id", F.col("r.hits").alias("redactions"))
    verdicts = table(spark, sf, "labels").select("doc_id", (F.col("toxic") == 1).alias("is_sensitive"))
    return gv.review_routing(cards, verdicts, "doc_id").select("doc_id", "review_status", "sanitization_status")


AUDIT_TEXT = ("concat(html, CASE page_id % 5 WHEN 0 THEN ' file:///Users/ann/x.txt' WHEN 1 THEN ' http://localhost:80/ 192.168.1.9 ' "
              "WHEN 2 THEN ' id 123e4567-e89b-12d3-a456-426614174000' ELSE ' /home/ann/work/a' END)")


@case("strict_public_audit", "WITH p AS (SELECT page_id, url, " + AUDIT_TEXT + " AS html FROM pages) " + " UNION ALL ".join(
    f"SELECT page_id, '{c}' AS \"column\", '{n}' AS name, unnest(regexp_extract_all({c}, {q(p)})) AS match, '{s}' AS severity FROM p"
    for c in ("url", "html") for n, p, s in gv.STRICT_PUBLIC))
def strict_public_audit(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url", F.expr(AUDIT_TEXT).alias("html"))
    return gv.strict_public_audit(p, "page_id", ["url", "html"])


ITEMS = 500 - len(DEFAULT_RULES)
ITEM_RULES = tuple(Rule(f"item_{n}", rf"\bitem-{n}\b", f"<ITEM {n}>", "low", (f"item-{n}",)) for n in range(ITEMS))
ITEM_TEXT = "concat(text, ' item-', CAST(doc_id % 600 AS STRING), ' kept')"


@case("redact_rule_table", f"""WITH t AS (SELECT doc_id, {ITEM_TEXT} AS text FROM documents), {rule_steps('t', 'text', keep='doc_id')}
 SELECT doc_id, CASE WHEN doc_id % 600 < {ITEMS} THEN regexp_replace(txt, ' item-(\\d+) kept$', ' <ITEM \\1> kept') ELSE txt END AS text,
  concat_ws(',', nullif({hits_text_sql()}, ''), CASE WHEN doc_id % 600 < {ITEMS} THEN 'item_' || (doc_id % 600) || ':1' END) AS hits FROM r""")
def redact_rule_table(spark, sf):
    """Five hundred rules from a table, most of which most texts do not call for."""
    rules = rule_table.rules_of(rule_table.rules_table(spark, DEFAULT_RULES + ITEM_RULES))
    d = spread(table(spark, sf, "documents")).select("doc_id", F.expr(ITEM_TEXT).alias("text"))
    out = rule_table.redact_by_table(d, "text", rules)
    names = F.map_filter("redactions", lambda k, _: ~F.startswith(k, F.lit("item_")))
    items = F.map_filter("redactions", lambda k, _: F.startswith(k, F.lit("item_")))
    hits = F.concat_ws(",", F.nullif(hits_text(names), F.lit("")), F.nullif(hits_text(items), F.lit("")))
    return out.select("doc_id", F.col("text_redacted").alias("text"), hits.alias("hits"))
