"""Case registry and the tables every case derives from the given data.

The given tables hold conversations but no tools, markers or secrets, so those are derived
by the same SQL text in both engines; every derived table grows with the given ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions.rules import DEFAULT_RULES, Rule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def case(key: str, sql: str | None = None):
    def register(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Ahead of CPU-heavy expressions: an input that comes in fewer pieces than the session
    has cores is dealt out; an input of many splits is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


# --- derived turns, one SQL text for both engines ----------------------------------------

TURNS_SQL = """
SELECT concat('s', CAST(conv_id AS STRING)) AS session_id, conv_id, 2 * turn AS turn_index, role,
       concat(text,
              CASE WHEN (conv_id + turn) % 7 = 0 THEN concat(' Write to user', CAST(conv_id AS STRING),
                   '@example.com or 192.0.2.', CAST(turn AS STRING), ' now.') ELSE '' END,
              CASE WHEN (conv_id + turn) % 11 = 3 THEN concat(' See /home/user', CAST(conv_id AS STRING),
                   '/notes.txt') ELSE '' END,
              CASE WHEN (conv_id * 3 + turn) % 13 = 4 THEN concat(' password = Zq', CAST(100000000000000 + conv_id AS STRING),
                   ' kept') ELSE '' END,
              CASE WHEN role = 'assistant' AND conv_id % 4 = 1 THEN concat(chr(10), '[task-summary]: Refactor module ',
                   CAST(conv_id AS STRING), '.') ELSE '' END) AS content,
       conv_id * 3600 + turn * 60 AS sec,
       CASE WHEN role = 'assistant' AND conv_id % 3 = 1 THEN concat('c', CAST(conv_id AS STRING), '-', CAST(turn AS STRING))
            ELSE '' END AS call_id,
       CASE WHEN turn % 4 = 1 THEN 'Bash' ELSE 'Read' END AS tool_name,
       concat('cat /home/user', CAST(conv_id AS STRING), '/f', CAST(turn AS STRING), '.txt') AS tool_cmd,
       '' AS tool_result_for
FROM {conversations}
UNION ALL
SELECT concat('s', CAST(conv_id AS STRING)), conv_id, 2 * turn + 1, 'tool', concat('exit ', CAST(turn AS STRING)),
       conv_id * 3600 + turn * 60 + 5, '', '', '', concat('c', CAST(conv_id AS STRING), '-', CAST(turn AS STRING))
FROM {conversations} WHERE role = 'assistant' AND conv_id % 3 = 1 AND turn % 5 <> 3
"""

BASE_SECOND = 1_704_067_200  # 2024-01-01T00:00:00Z


def turns(spark: SparkSession, sf: str) -> DataFrame:
    conv = spread(table(spark, sf, "conversations"))
    raw = spark.sql(TURNS_SQL, conversations=conv)
    return raw.select(
        "session_id", "conv_id", "turn_index", "role", "content",
        F.date_format(F.timestamp_seconds(F.col("sec") + BASE_SECOND),
                      "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
        F.when(F.col("call_id") != "", F.array(F.struct(
            F.col("call_id").alias("id"), F.col("tool_name").alias("name"),
            F.concat(F.lit('{"cmd":"'), "tool_cmd", F.lit('","n":1}')).alias("input"))))
        .otherwise(F.array().cast("array<struct<id:string,name:string,input:string>>"))
        .alias("tool_calls"),
        "tool_result_for")


def turns_cte(name: str = "turns") -> str:
    """CTE text for the check engine."""
    body = TURNS_SQL.replace("{conversations}", "conversations")
    return f"""{name}_raw AS ({body}),
{name} AS (SELECT *, strftime(make_timestamp((sec + {BASE_SECOND}) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS ts,
  CASE WHEN call_id <> '' THEN concat('{{"cmd":"', tool_cmd, '","n":1}}') ELSE '' END AS tool_input
  FROM {name}_raw)"""


# --- redaction in the check engine -----------------------------------------------------

def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rule_steps(source: str, col: str, rules: tuple[Rule, ...] = DEFAULT_RULES, tag: str = "r",
               keep: str = "*") -> str:
    """CTE chain ``tag_0 .. tag_n``: ``tag_n`` has ``txt`` and one count column per rule."""
    parts = [f"{tag}_0 AS (SELECT {keep}, {col} AS txt FROM {source})"]
    for i, r in enumerate(rules, start=1):
        pattern, place = r.oracle or (r.pattern, r.placeholder.replace("$", "\\"))
        parts.append(
            f"{tag}_{i} AS (SELECT * EXCLUDE (txt), regexp_replace(txt, {q(pattern)}, {q(place)}, 'g') AS txt, "
            f"CAST(len(regexp_extract_all(txt, {q(pattern)})) AS BIGINT) AS h_{r.name} FROM {tag}_{i - 1})")
    parts.append(f"{tag} AS (SELECT * FROM {tag}_{len(rules)})")
    return ",\n".join(parts)


def hits_text_sql(rules: tuple[Rule, ...] = DEFAULT_RULES, fmt: str = "h_{}") -> str:
    names = sorted(r.name for r in rules)
    cells = ", ".join(f"CASE WHEN {fmt.format(n)} > 0 THEN concat('{n}:', CAST({fmt.format(n)} AS VARCHAR)) END"
                      for n in names)
    return f"concat_ws(',', {cells})"


def hits_text(col) -> "F.Column":
    """A hit map as sorted text, so both engines compare the same scalar."""
    entries = F.array_sort(F.transform(F.map_entries(col), lambda e: F.concat(
        e["key"], F.lit(":"), e["value"].cast("string"))))
    return F.array_join(entries, ",")
