"""Session listings, look-up by id or prefix, raw file manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.session import many_folders
from tracelake.sources.base import JSON

HEAD_LINES = 5


def session_files(lines: DataFrame) -> DataFrame:
    """One row per session file with folder and version from its first five lines."""
    first = lines.filter("block = 0").groupBy("session_id").agg(F.min("seq").alias("_first"))
    head = (lines.filter("block = 0").join(first, "session_id").filter(F.col("seq") < F.col("_first") + HEAD_LINES)
            .withColumn("j", F.from_json("raw", "cwd string, version string", JSON)))

    def early(c):
        return F.min_by(F.when(F.col(f"j.{c}") != "", F.col(f"j.{c}")),
                        F.when(F.col(f"j.{c}") != "", F.col("seq"))).alias(c)

    heads = head.groupBy("session_id").agg(early("cwd"), early("version"))
    files = lines.groupBy("session_id").agg(F.max("mtime").alias("mtime"), F.max("size_bytes").alias("size_bytes"))
    return files.join(heads, "session_id", "left").fillna("", ["cwd", "version"])


def list_sessions(lines: DataFrame, n: int = 50) -> DataFrame:
    """Newest sessions. The list is cut before any line is parsed."""
    files = lines.groupBy("session_id").agg(F.max("mtime").alias("mtime"))
    newest = files.orderBy(F.desc("mtime"), F.desc("session_id")).limit(n).select("session_id")
    return session_files(lines.join(newest, "session_id", "left_semi"))


def find_sessions(sessions: DataFrame, ident: str) -> DataFrame:
    """Exact id; without one, every id that starts with it."""
    exact = sessions.filter(F.col("session_id") == ident)
    near = sessions.filter(F.startswith("session_id", F.lit(ident)) & (F.col("session_id") != ident))
    found = exact.limit(1).select(F.col("session_id").alias("_start"))
    start = F.substring("session_id", 1, len(ident))
    return exact.unionByName(near.withColumn("_start", start).join(found, "_start", "left_anti").drop("_start"))


def latest(sessions: DataFrame) -> DataFrame:
    return sessions.orderBy(F.desc("mtime"), F.desc("session_id")).limit(1)


def raw_manifest(spark: SparkSession, path: str, cap: int | None = None, glob: str | None = None,
                 with_bytes: bool = False) -> DataFrame:
    """Size and SHA-256 of raw files. With a cap (8 MiB is usual for uploads) larger files show
    only their size; the length filter is pushed into the scan, so they are never opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    with many_folders(spark):
        files = reader.load(path)
    small = files if cap is None else files.filter(F.col("length") <= cap)
    small = small.select(
        "path", F.col("length").alias("raw_size_bytes"), F.sha2("content", 256).alias("raw_sha256"),
        *([F.base64("content").alias("raw_b64")] if with_bytes else []), F.lit(False).alias("raw_truncated"))
    if cap is None:
        return small
    big = files.filter(F.col("length") > cap).select(
        "path", F.col("length").alias("raw_size_bytes"), F.lit(None).cast("string").alias("raw_sha256"),
        *([F.lit(None).cast("string").alias("raw_b64")] if with_bytes else []), F.lit(True).alias("raw_truncated"))
    return small.unionByName(big)
