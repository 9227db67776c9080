"""A training corpus from raw documents, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it kept; its
result is written as Parquet to the shared folder and read again as the next one's documents.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.session import materialize

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and so do the documents that the line-first rules reject."""
    from tracelake.llm.quality import clean

    judged = clean(docs, cleaned="clean_text").filter("kept").drop("text").withColumnRenamed("clean_text", "text")
    return judged.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8) stays; rows without id stay.

    A row goes by its own id and text: of two texts under one id, the one that copies a smaller id goes and
    the other one stays. Of rows equal in both one stays.
    """
    from tracelake.llm.minhash import near_duplicates as judge
    from tracelake.llm.minhash import text_key

    gone = judge(docs, shingle=5, threshold=0.8).filter("NOT kept").select("doc_id", F.col("text_key").alias("_text")).distinct()
    rest = docs.withColumn("_text", text_key("text")).join(materialize(gone, "copies"), ["doc_id", "_text"], "left_anti").drop("_text")
    again = materialize(rest.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 AND doc_id IS NOT NULL").select("doc_id"), "repeated")
    if again.head(1):  # one document in several rows
        rest = rest.join(again, "doc_id", "left_anti").unionByName(rest.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]))
    return rest.select(*DOCUMENT)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    from tracelake.llm.personal import mask

    return mask(docs.select(*DOCUMENT)).withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target weights by Poisson replication, all rows shuffled."""
    from tracelake.llm.mixing import mix

    return mix(docs).select(*DOCUMENT)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences of at most 4096 tokens."""
    from tracelake.llm.packing import pack

    return pack(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mixing", mixing), ("packing", packing)]

#: The stages train a model and count tokens, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
