"""Tables cut by a hash of their key, of which a change rewrites only the parts it touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.session import materialize

PARTS = 64


def part_of(key: str, parts: int = PARTS) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(parts)).cast("int")


def write_hashed(rows: DataFrame, path: str, key: str, parts: int = PARTS) -> None:
    """Store a table in ``parts`` folders by the hash of its key."""
    rows.withColumn("part", part_of(key, parts)).repartition("part").write.mode("overwrite").partitionBy("part").parquet(path)


def read_hashed(spark: SparkSession, path: str, touched: list[int] | None = None) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows.drop("part") if touched is None else rows.filter(F.col("part").isin(touched)).drop("part")


def _replace(spark: SparkSession, path: str, rows: DataFrame, key: str, parts: int, touched: list[int]) -> None:
    """Write the touched folders anew; one that nothing is left for goes. Each folder changes by itself, and
    repeating the change gives the same table."""
    rows = materialize(rows.withColumn("part", part_of(key, parts)), "parts")
    left = {r["part"] for r in rows.select("part").distinct().collect()}  # at most ``parts``
    rows.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
    for p in sorted(set(touched) - left):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/part={p}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def touched_parts(ids: DataFrame, key: str, parts: int = PARTS) -> list[int]:
    return sorted(r[0] for r in ids.select(part_of(key, parts)).distinct().collect())


def remove_hashed(spark: SparkSession, path: str, ids: DataFrame, key: str, parts: int = PARTS) -> list[int]:
    """Remove the rows of some keys; gives the folders that were written."""
    touched = touched_parts(ids, key, parts)
    if touched:
        _replace(spark, path, read_hashed(spark, path, touched).join(ids.select(key).distinct(), key, "left_anti"), key, parts, touched)
    return touched


def upsert_hashed(spark: SparkSession, path: str, rows: DataFrame, key: str, by: list[str], parts: int = PARTS) -> list[int]:
    """Rows replace stored ones that agree in ``by`` (which holds ``key``); gives the folders that were written."""
    rows = materialize(rows, "new")
    touched = touched_parts(rows, key, parts)
    if touched:
        old = read_hashed(spark, path, touched)
        _replace(spark, path, old.join(rows.select(*by).distinct(), by, "left_anti").unionByName(rows.select(*old.columns)), key, parts, touched)
    return touched
