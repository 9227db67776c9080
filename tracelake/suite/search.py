"""Vector search on the given embeddings with derived owners, teams and access."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.operators import hashing
from tracelake.operators import search as op
from tracelake.session import materialize
from tracelake.suite.registry import case, table, turns, turns_cte

EXPERIENCES = """SELECT concat('x', CAST(vec_id AS STRING)) AS experience_id, vec_id, embedding, concat('o', CAST(vec_id % 7 AS STRING)) AS owner,
 CASE vec_id % 3 WHEN 0 THEN 'private' WHEN 1 THEN concat('team:', CASE WHEN vec_id % 2 = 0 THEN 'blue' ELSE 'red' END) ELSE 'public' END AS acl,
 CASE WHEN vec_id % 4 = 2 THEN 'private' ELSE 'published' END AS publish_status,
 CASE WHEN vec_id % 17 = 0 THEN 'revoked' WHEN vec_id % 5 = 0 THEN 'pending' ELSE 'approved' END AS review_status,
 CASE WHEN vec_id % 10 = 5 THEN 'human_review' ELSE 'layer1_only' END AS sanitization_status,
 CASE WHEN label % 2 = 0 THEN 'debug' ELSE 'build' END AS task_type, vec_id * 100 AS created_at FROM {embeddings}"""
EXP_CTE = "e AS (" + EXPERIENCES.format(embeddings="embeddings") + ")"
# one asking viewer per label; it searches with the mean vector of that label, so the queries
# come from the whole table and stay few
CENTRES_DUCK = """SELECT label, list(m ORDER BY pos) AS query_vec FROM (SELECT label, pos, avg(x) AS m FROM (
  SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY 1, 2) GROUP BY 1"""
VIEWERS = """SELECT concat('v', CAST(label AS STRING)) AS query_id, query_vec, concat('o', CAST(label % 9 AS STRING)) AS owner,
 CASE WHEN label % 2 = 0 THEN 'blue' ELSE 'red' END AS team, label % 3 <> 0 AS unlocked FROM {centres}"""
VIEW_CTE = "centres AS (" + CENTRES_DUCK + "), v AS (" + VIEWERS.format(centres="centres") + ")"
SIM = "list_cosine_similarity(query_vec::DOUBLE[], embedding::DOUBLE[])"
HELD = "(sanitization_status = 'human_review' AND review_status <> 'approved')"
MINE = "e.owner = v.owner"
TEAM = f"(NOT {HELD} AND acl = 'team:' || team)"
PUBLIC = f"(NOT {HELD} AND acl = 'public' AND publish_status = 'published' AND unlocked)"
LIVE = "review_status <> 'revoked'"


def experiences(spark, sf):
    return spark.sql(EXPERIENCES, embeddings=table(spark, sf, "embeddings"))


def viewers(spark, sf):
    e = table(spark, sf, "embeddings")
    means = e.select("label", F.posexplode("embedding").alias("pos", "x")).groupBy("label", "pos").agg(
        F.avg(F.col("x").cast("double")).alias("m"))
    centres = means.groupBy("label").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda p: p["m"]).alias("query_vec"))
    return spark.sql(VIEWERS, centres=centres)


def rounded(df):
    return df.withColumn("similarity", F.round("similarity", 5) + F.lit(0.0))


def ranked_sql(where: str, k: int, cols: str = "query_id, experience_id") -> str:
    return f"""WITH {EXP_CTE}, {VIEW_CTE}, s AS (SELECT {cols}, {SIM} AS sim FROM v, e WHERE {where})
 SELECT {cols}, round(sim, 5) + 0.0 AS similarity, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, experience_id) AS rank_no
 FROM s QUALIFY rank_no <= {k}"""


COSINE_SQL = f"""WITH {VIEW_CTE} SELECT query_id, vec_id, round(sim, 5) + 0.0 AS similarity, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rank_no
 FROM (SELECT query_id, vec_id, {SIM} AS sim FROM v, embeddings) QUALIFY rank_no <= 5"""


@case("cosine_topk", COSINE_SQL)
def cosine_topk(spark, sf):
    return rounded(op.cosine_topk(viewers(spark, sf), table(spark, sf, "embeddings")))


@case("topk_per_query", COSINE_SQL.replace("<= 5", "<= 3"))
def topk_per_query(spark, sf):
    best = op.cosine_topk(viewers(spark, sf), table(spark, sf, "embeddings"), 8).drop("rank_no")
    return rounded(op.topk_per_query(best, 3))


@case("ann_topk", COSINE_SQL)
def ann_topk(spark, sf):
    cells, pivots = op.build_cells(table(spark, sf, "embeddings"), 16)
    stored = materialize(cells, "cells")
    return rounded(op.cell_topk(viewers(spark, sf), stored, pivots))


@case("ann_hashed", COSINE_SQL)
def ann_hashed(spark, sf):
    """Approximate, with recall measured; on the given tables it finds all."""
    index = hashing.build_hash_index(table(spark, sf, "embeddings"))
    return rounded(hashing.hashed_topk(viewers(spark, sf), index, min_recall=1.0))


@case("similarity_threshold", f"SELECT * FROM ({COSINE_SQL}) WHERE similarity > 0.25")
def similarity_threshold(spark, sf):
    return op.similarity_threshold(cosine_topk(spark, sf), 0.25)


@case("acl_filtered_search", ranked_sql(f"{LIVE} AND ({MINE} OR {TEAM} OR {PUBLIC})", 5))
def acl_filtered_search(spark, sf):
    return rounded(op.acl_filtered_search(viewers(spark, sf), experiences(spark, sf)))


@case("scoped_search", ranked_sql(f"task_type = 'debug' AND {LIVE} AND {PUBLIC}", 4))
def scoped_search(spark, sf):
    return rounded(op.acl_filtered_search(viewers(spark, sf), experiences(spark, sf), 4, "community", "debug"))


@case("merge_scopes", f"""WITH {EXP_CTE}, {VIEW_CTE}, p AS (SELECT query_id, experience_id, {SIM} AS sim, 'personal' AS source FROM v, e
  WHERE {LIVE} AND ({MINE} OR {TEAM}) QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, experience_id) <= 5),
 c AS (SELECT query_id, experience_id, {SIM} AS sim, 'community' AS source FROM v, e WHERE {LIVE} AND {PUBLIC}
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, experience_id) <= 5),
 u AS (SELECT query_id, experience_id, max(sim) AS sim, max(source) AS source FROM (FROM p UNION ALL FROM c) GROUP BY 1, 2)
 SELECT query_id, experience_id, round(sim, 5) + 0.0 AS similarity, source, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, experience_id) AS rank_no FROM u QUALIFY rank_no <= 5""")
def merge_scopes(spark, sf):
    v, e = viewers(spark, sf), experiences(spark, sf)
    p = op.acl_filtered_search(v, e, 5, "personal").drop("rank_no")
    c = op.acl_filtered_search(v, e, 5, "community").drop("rank_no")
    return rounded(op.merge_scopes(p, c, 5))


@case("acl_join", f"""WITH {EXP_CTE}, {VIEW_CTE} SELECT query_id AS viewer, count(*) FILTER ({LIVE} AND {MINE}) AS n_own,
 count(*) FILTER ({LIVE} AND {TEAM}) AS n_team, count(*) FILTER ({LIVE} AND {PUBLIC}) AS n_community,
 count(*) FILTER ({LIVE} AND ({MINE} OR {TEAM} OR {PUBLIC})) AS n_visible FROM v, e GROUP BY query_id""")
def acl_join(spark, sf):
    return op.acl_join(viewers(spark, sf).withColumnRenamed("query_id", "viewer"), experiences(spark, sf))


@case("visible_rows", f"WITH {EXP_CTE}, v AS (SELECT 'o3' AS owner, 'red' AS team, TRUE AS unlocked) SELECT experience_id FROM v, e WHERE {LIVE} AND ({MINE} OR {TEAM} OR {PUBLIC})")
def visible_rows(spark, sf):
    return op.visible_rows(experiences(spark, sf), "o3", "red", True).select("experience_id")


@case("personal_recent", f"WITH {EXP_CTE} SELECT experience_id, created_at FROM e WHERE owner = 'o3' ORDER BY created_at DESC, experience_id LIMIT 20")
def personal_recent(spark, sf):
    from tracelake.operators.governance import personal_recent as recent
    return recent(experiences(spark, sf), "o3").select("experience_id", "created_at")


@case("get_experience", f"""WITH {EXP_CTE}, {turns_cte()} SELECT experience_id, owner, acl, turn_index, role, content,
  count(*) OVER () AS turn_count FROM e JOIN turns ON 'x' || conv_id = experience_id WHERE experience_id = 'x7'""")
def get_experience(spark, sf):
    t = turns(spark, sf).withColumn("experience_id", F.concat(F.lit("x"), F.col("conv_id").cast("string")))
    one = op.get_experience(experiences(spark, sf), t, "x7")
    counts = one.groupBy("experience_id").agg(F.count("turn_index").alias("turn_count"))
    return one.join(counts, "experience_id").select("experience_id", "owner", "acl", "turn_index", "role", "content", "turn_count")


@case("text_vectors", f"""WITH {turns_cte()},
 w AS (SELECT session_id, turn_index, unnest(string_split_regex(lower(content), '[^\\p{{L}}\\p{{N}}]+')) AS word FROM turns WHERE role = 'user'),
 n AS (SELECT session_id, turn_index, CAST('0x' || substring(md5(word), 1, 8) AS BIGINT) % 64 AS slot, 1 + ln(count(*)) AS c FROM w WHERE word <> '' GROUP BY ALL),
 u AS (SELECT *, sqrt(sum(c * c) OVER (PARTITION BY session_id, turn_index)) AS norm FROM n)
 SELECT session_id, turn_index, CAST(slot AS INTEGER) AS slot, round(c / norm, 6) AS value FROM u""")
def text_vectors(spark, sf):
    from tracelake.functions.vectors import text_vectors as build
    t = turns(spark, sf).filter("role = 'user'").select(F.struct("session_id", "turn_index").alias("key"), "content")
    return build(t, "key", "content").select("key.session_id", "key.turn_index", F.posexplode("vector").alias("slot", "v")).filter(
        "v <> 0").select("session_id", "turn_index", "slot", F.round("v", 6).alias("value"))
