"""Stand-in text vectors: signed feature hashing into a fixed number of dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIM = 64


def text_vectors(df: DataFrame, key: str, text: str, dim: int = DIM) -> DataFrame:
    """(key, vector ARRAY<DOUBLE>): unit vectors of hashed word counts, weighted by 1 + log of
    the count. ``key`` names a row. A supplied embedding column is used instead wherever there
    is one."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"),
                     lambda w: w != "")
    slot = lambda w: F.pmod(F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long"), F.lit(dim))
    hashed = df.select(key, F.transform(words, slot).alias("_h"))
    # one pass: counts of slots that occur, then placed into the whole vector
    counts = hashed.select(key, F.explode_outer("_h").alias("_s")).groupBy(key, "_s").agg(F.count("_s").alias("_c"))
    weight = F.when(F.col("_c") > 0, 1.0 + F.log(F.col("_c").cast("double"))).otherwise(F.lit(0.0))
    held = counts.groupBy(key).agg(F.map_from_entries(F.collect_list(
        F.struct(F.coalesce("_s", F.lit(-1).cast("long")).alias("k"), weight.alias("v")))).alias("_m"))
    raw = held.select(key, F.transform(F.sequence(F.lit(0).cast("long"), F.lit(dim - 1).cast("long")), lambda i: F.coalesce(
        F.element_at("_m", i), F.lit(0.0))).alias("_v"))
    norm = F.sqrt(F.aggregate("_v", F.lit(0.0), lambda a, x: a + x * x))
    return raw.withColumn("_n", norm).select(key, F.transform(
        "_v", lambda x: F.when(F.col("_n") > 0, x / F.col("_n")).otherwise(x)).alias("vector"))
