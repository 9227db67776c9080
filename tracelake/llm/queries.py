"""Registered queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def case(key: str, sql: str | None = None):
    def register(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@case("op1_pack")
def op1_pack(spark: SparkSession, sf: str) -> DataFrame:
    from tracelake.llm.packing import pack

    return pack(table(spark, sf, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@case("op6_quality")
def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    from tracelake.llm.quality import clean

    docs = table(spark, sf, "documents").select("doc_id", "text")
    return clean(docs, cleaned=None).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_bad_lines", "n_lost_words")


@case("op2_minhash")
def op2_minhash(spark: SparkSession, sf: str) -> DataFrame:
    from tracelake.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf, "documents"), shingle=4, threshold=0.8).drop("text_key")


@case("op9_suffix")
def op9_suffix(spark: SparkSession, sf: str) -> DataFrame:
    from tracelake.llm.passages import remove_passages

    return remove_passages(table(spark, sf, "documents"), length=50)


MIX_SQL = """
WITH counted AS (SELECT coalesce(source, '') AS source, count(*) AS n FROM documents GROUP BY 1),
rates AS (SELECT source, sqrt(n) / (SELECT sum(sqrt(n)) FROM counted) * (SELECT sum(n) FROM counted) / n AS rate FROM counted),
logs AS (SELECT k, sum(CASE WHEN k = 0 THEN 0 ELSE ln(k) END) OVER (ORDER BY k) AS logfact
         FROM (SELECT unnest(range(0, 2 + CAST((SELECT max(ceil(rate + 12 * sqrt(rate) + 40)) FROM rates) AS BIGINT))) AS k)),
steps AS (SELECT source, rate, k, sum(exp(k * ln(rate) - rate - logfact)) OVER (PARTITION BY source ORDER BY k) AS c FROM rates, logs),
draws AS (SELECT d.*,
                 CAST(CAST('0x' || substr(md5('0:' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
          FROM documents d),
counts AS (SELECT d.doc_id, d.source, d.lang, d.n_chars, d.text, s.rate, count(*) AS n FROM draws d JOIN steps s ON s.source = coalesce(d.source, '') AND s.c <= d.u GROUP BY ALL)
SELECT doc_id, source, lang, n_chars, text, CAST(copy AS INTEGER) AS copy, rate,
       md5('0:' || CAST(doc_id AS VARCHAR) || ':' || CAST(copy AS VARCHAR)) AS shuffle_key
FROM (SELECT *, unnest(range(0, n)) AS copy FROM counts)
"""


@case("op7_mix", MIX_SQL)
def op7_mix(spark: SparkSession, sf: str) -> DataFrame:
    from tracelake.llm.mixing import mix

    return mix(table(spark, sf, "documents"))


@case("op5_licenses")
def op5_licenses(spark: SparkSession, sf: str) -> DataFrame:
    from tracelake.llm.licences import scan

    return scan(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", F.size("matches").alias("n_matches"))


@case("op8_pii")
def op8_pii(spark: SparkSession, sf: str) -> DataFrame:
    from tracelake.llm.personal import find

    return find(table(spark, sf, "documents")).drop("found")


@case("op10_render")
def op10_render(spark: SparkSession, sf: str) -> DataFrame:
    from tracelake.llm.rendering import render

    pages = render(table(spark, sf, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").alias("n_chars"))


@case("op3_vectors")
def op3_vectors(spark: SparkSession, sf: str) -> DataFrame:
    from tracelake.llm.vectors import near_vectors

    return near_vectors(table(spark, sf, "embeddings"), threshold=0.98)


@case("op4_gru")
def op4_gru(spark: SparkSession, sf: str) -> DataFrame:
    from tracelake.llm.scoring import score_documents

    return score_documents(table(spark, sf, "documents"))


# a leaf's path: its run's other nodes at every level; the lowest bit of crc32 by shifting the bytes of the id through
MERKLE_SQL = """
WITH RECURSIVE told AS (
  SELECT doc_id, source, lang, n_chars, text,
   list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
     lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS lc
  FROM documents),
leaves AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos,
   sha256(HEAD || coalesce(strlen(text) || ':' || text, '-')) AS h,
   sha256(HEAD || coalesce(strlen(seen) || ':' || seen, '-')) AS seen
  FROM (SELECT *, CASE WHEN xor(lc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS seen,
          coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
          || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS HEAD FROM told)),
nodes AS (
  SELECT 0 AS lv, coalesce('s' || source, '') AS grp, pos, h, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT lv + 1, grp, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 2) // 3 FROM nodes WHERE n > 1 GROUP BY lv, grp, pos // 3),
subroots AS (SELECT grp, h AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
heads AS (
  SELECT 0 AS lv, pos, subroot AS h, n FROM subroots
  UNION ALL
  SELECT lv + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 2) // 3 FROM heads WHERE n > 1 GROUP BY lv, pos // 3),
folds AS (
  SELECT doc_id, coalesce('s' || source, '') AS grp, h AS leaf, 0 AS lv, pos, seen AS node, '' AS proof FROM leaves
  UNION ALL
  SELECT f.doc_id, f.grp, f.leaf, f.lv + 1, f.pos // 3,
   sha256(string_agg(CASE WHEN s.pos = f.pos THEN f.node ELSE s.h END, '' ORDER BY s.pos)),
   f.proof || coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos <> f.pos), '')
  FROM folds f JOIN nodes s ON s.grp = f.grp AND s.lv = f.lv AND s.pos // 3 = f.pos // 3 AND s.n > 1
  GROUP BY f.doc_id, f.grp, f.leaf, f.lv, f.pos, f.node, f.proof),
ends AS (SELECT f.doc_id, f.leaf, f.node, f.proof, s.subroot, s.pos FROM (SELECT *, max(lv) OVER (PARTITION BY doc_id) AS last FROM folds) f JOIN subroots s ON s.grp = f.grp WHERE f.lv = f.last),
tops AS (
  SELECT doc_id, leaf, subroot, 0 AS lv, pos, node, proof FROM ends
  UNION ALL
  SELECT f.doc_id, f.leaf, f.subroot, f.lv + 1, f.pos // 3,
   sha256(string_agg(CASE WHEN s.pos = f.pos THEN f.node ELSE s.h END, '' ORDER BY s.pos)),
   f.proof || coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos <> f.pos), '')
  FROM tops f JOIN heads s ON s.lv = f.lv AND s.pos // 3 = f.pos // 3 AND s.n > 1
  GROUP BY f.doc_id, f.leaf, f.subroot, f.lv, f.pos, f.node, f.proof),
done AS (SELECT *, max(lv) OVER () AS last FROM tops)
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = r.h AS verified
FROM done, (SELECT h FROM heads WHERE n = 1) r WHERE done.lv = done.last
"""


@case("op12_merkle", MERKLE_SQL)
def op12_merkle(spark: SparkSession, sf: str) -> DataFrame:
    from tracelake.llm.manifest import manifest

    # in every document whose crc32(doc_id) is even, line breaks are lost before the check
    damaged = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return manifest(table(spark, sf, "documents"), observed={"text": damaged}).drop("proof")


NEGATIVES_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@case("op11_bond", NEGATIVES_SQL)
def op11_bond(spark: SparkSession, sf: str) -> DataFrame:
    from tracelake.llm.negatives import mine

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf, "embeddings").withColumn("label", label)
    return mine(vectors, anchors=F.col("vec_id") % 50 == 0)


@case("op13_descent")
def op13_descent(spark: SparkSession, sf: str) -> DataFrame:
    from tracelake.llm.neighbours import nearest

    return nearest(table(spark, sf, "embeddings"), queries=F.col("vec_id") % 20 == 0, k=20)
