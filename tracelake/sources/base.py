"""Reading raw lines and documents, JSON helpers, and dense turn numbers.

A raw line is (session_id, block, seq, raw): ``block`` is the offset of the file split it was
read from and ``seq`` grows inside a split, so (block, seq) is file order without putting a
file into one task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions import text as tx
from tracelake.operators.scan import CHUNK, running
from tracelake.session import many_folders

JSON = {"allowSingleQuotes": "false"}
CALLS = "array<struct<id:string,name:string,input:string>>"
TURN = ("role:string,content:string,tool_calls:" + CALLS + ",tool_result_for:string")


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")


def session_key(path: Column) -> Column:
    """A session is a file: its stem, for people and look-ups by prefix, and a digest of its
    whole path, so that equal names in two folders stay two sessions."""
    return F.concat(file_stem(path), F.lit("@"), F.substring(F.sha2(path, 256), 1, 12))


def _reader(spark: SparkSession, glob: str | None, since: str | None):
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.option("modifiedAfter", since) if since else reader


def _sized(files: DataFrame, max_kb: int | None) -> DataFrame:
    """Size cap on file metadata, right on the scan: larger files are never opened."""
    return files.filter(F.col("_metadata.file_size") <= max(64, max_kb) * 1024) if max_kb else files


def read_lines(spark: SparkSession, path: str, glob: str | None = None,
               max_kb: int | None = None, since: str | None = None) -> DataFrame:
    """Text lines with file order. Size and time filters prune files before they are opened."""
    with many_folders(spark):
        files = _sized(_reader(spark, glob, since).text(path), max_kb)
    lines = files.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").alias("raw"),
        F.col("_metadata.file_modification_time").alias("mtime"),
        F.col("_metadata.file_size").alias("size_bytes")).withColumn("session_id", session_key(F.col("path")))
    if max_kb and max(64, max_kb) * 1024 <= least_split(spark):
        # no file of this size is ever split: numbering needs no second look at the files
        lines = lines.withColumn("_multi", F.lit(False))
    return lines


def read_docs(spark: SparkSession, path: str, glob: str | None = None,
              max_kb: int | None = None, since: str | None = None) -> DataFrame:
    """Whole files: formats that are one JSON document or one markdown page per file."""
    with many_folders(spark):
        docs = _sized(_reader(spark, glob, since).text(path, wholetext=True), max_kb)
    return docs.select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"),
        F.col("_metadata.file_modification_time").alias("mtime"),
        F.col("_metadata.file_size").alias("size_bytes")).withColumn("session_id", session_key(F.col("path")))


def _bytes(value: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", value.strip().lower()).groups()
    return int(number) * 1024 ** " kmgt".index(unit or " ")


def least_split(spark: SparkSession) -> int:
    """The smallest size at which a file may be read in more than one split."""
    return min(_bytes(spark.conf.get("spark.sql.files.openCostInBytes", "4mb")),
               _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "128mb")))


def with_multi(lines: DataFrame) -> DataFrame:
    """Lines with ``_multi``: whether their file may be read in more than one split. A file
    no larger than the smallest split size never is, and needs no carry between splits."""
    if "_multi" in lines.columns:
        return lines
    if "size_bytes" not in lines.columns:
        return lines.withColumn("_multi", F.lit(True))
    return lines.withColumn("_multi", F.col("size_bytes") > least_split(lines.sparkSession))


def number_turns(found: DataFrame) -> DataFrame:
    """Rows (session_id, block, seq, sub, turn...) to turns with a dense ``turn_index``. The
    file split is the chunk of the running count. With ``_multi`` the counts are taken from
    split files only, so the others are parsed once."""
    return running(found, ["session_id"], ["block", "seq", "sub"],
                   chunk=F.struct("block", F.floor(F.col("sub") / CHUNK)),
                   sums={"turn_index": F.lit(1)},
                   carry_from=F.col("_multi") if "_multi" in found.columns else None).select(
        "session_id", "turn_index", "role", "content", "ts", "tool_calls", "tool_result_for")


def no_calls() -> Column:
    return F.array().cast(CALLS)


def turn(role, content: Column, calls: Column | None = None, result_for: Column | None = None) -> Column:
    """One turn struct of the fixed type."""
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(
        role.alias("role"), F.coalesce(content, F.lit("")).alias("content"),
        (no_calls() if calls is None else F.coalesce(calls, no_calls())).alias("tool_calls"),
        F.coalesce(F.lit("") if result_for is None else result_for, F.lit("")).alias("tool_result_for"))


def no_turns() -> Column:
    return F.array().cast(f"array<struct<{TURN}>>")


def one_if(cond: Column, t: Column) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), F.array(t)).otherwise(no_turns())


def dump(text: Column) -> Column:
    """JSON text as it is shown in turns: one blank after commas and colons."""
    return tx.spaced_json(text)


def join_text(parts: Column, keep_blank: bool = False) -> Column:
    parts = F.coalesce(parts, F.array().cast("array<string>"))
    said = F.filter(parts, lambda p: p.isNotNull() if keep_blank else tx.strip(p) != "")
    return F.array_join(said, "\n")


BLOCK = ("type string, text string, thinking string, id string, name string, input string, "
         "arguments string, tool_use_id string, content string, is_error string")


def blocks(items: Column) -> Column:
    """JSON texts of content blocks to structs; ``kind`` is the JSON kind of a tool result's
    content, ``items`` its list form."""
    def read(b: Column) -> Column:
        f = F.from_json(b, BLOCK, JSON)
        kind = F.when(F.contains(b, F.lit('"tool_result"')),
                      F.schema_of_variant(F.from_json(b, "content variant", JSON)["content"]))
        return F.struct(b.alias("raw"), f.alias("f"), F.coalesce(kind, F.lit("")).alias("kind"))
    return F.transform(F.coalesce(items, F.array().cast("array<string>")), read)


def is_dict(b: Column) -> Column:
    return F.startswith(b["raw"], F.lit("{"))


def of_type(bs: Column, *types: str) -> Column:
    return F.filter(bs, lambda b: is_dict(b) & b["f"]["type"].isin(*types))


def result_text(b: Column, images: bool = False) -> Column:
    """Text of a tool result: list -> its text parts, string as is, else printed JSON."""
    parts = F.from_json(b["f"]["content"], "array<struct<type:string,text:string>>", JSON)
    text = F.transform(parts, lambda p: F.when(
        p["type"] == "text", F.coalesce(p["text"], F.lit(""))).when(
        F.lit(images) & (p["type"] == "image"), F.lit("[image]")))
    return (F.when(F.startswith(b["kind"], F.lit("ARRAY")), join_text(text, keep_blank=True))
             .when(b["kind"] == "STRING", b["f"]["content"]).when(b["kind"] == "VOID", "null")
             .when(b["kind"] == "", "").otherwise(dump(b["f"]["content"])))


def call_struct(call_id: Column, name: Column, payload: Column) -> Column:
    return F.struct(F.coalesce(call_id, F.lit("")).alias("id"), F.coalesce(name, F.lit("")).alias("name"),
                    F.coalesce(payload, F.lit("{}")).alias("input"))


def quote_json(c: Column) -> Column:
    """A text as JSON string literal."""
    listed = F.to_json(F.array(c))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def explode_turns(df: DataFrame, turns: Column, keep: list[str]) -> DataFrame:
    return df.select(*keep, F.posexplode(turns).alias("sub", "_t")).select(
        *keep, "sub", "_t.role", "_t.content", "_t.tool_calls", "_t.tool_result_for")
