"""An index of the stored fingerprints, laid out so that a batch reads only what it may meet.

``fingerprints`` has one folder per batch. The index ``ledger`` has, below each batch, one folder per
fingerprint prefix; inside, rows are sorted by fingerprint and files carry Bloom filters of it. A batch
that looks for its fingerprints lists and reads the folders of its own prefixes, and of those only row
groups that may hold one of them, so what a small batch reads does not grow with the history.
Batches that something else has written, without an index, are read as they are. ``compact`` merges the
index folders of finished batches, which bounds the number of folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.session import many_folders, materialize

DIGITS = 2          # hexadecimal digits of a prefix: 256 folders
LOOKUPS = 2000      # fingerprints that are handed to the reader as values
LISTED = 32         # of them in one list: the reader makes a chain of comparisons of each, and of long ones overflows its stack
PRINTS = "agent_id string, fingerprint string, session_id string, experience_id string"
SCHEMA = PRINTS + ", batch string, prefix string"
IN_CONF = "spark.sql.parquet.pushdown.inFilterThreshold"


def prefix_of(fingerprint: Column) -> Column:
    return F.concat(F.lit("p"), F.substring(fingerprint, 1, DIGITS))


def write_ledger(rows: DataFrame, out: str, batch: str) -> None:
    """Replace the index of one batch; repeating a batch leaves one copy."""
    (rows.withColumn("prefix", prefix_of(F.col("fingerprint"))).repartition("prefix").sortWithinPartitions("prefix", "fingerprint")
     .write.mode("overwrite").option("parquet.bloom.filter.enabled#fingerprint", "true")
     .option("parquet.bloom.filter.adaptive.enabled", "true").partitionBy("prefix").parquet(f"{out}/ledger/batch={batch}"))


def _folder(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _batches(spark: SparkSession, path: str) -> set[str]:
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return set()
    names = (s.getPath().getName() for s in fs.listStatus(folder))
    return {n.removeprefix("batch=") for n in names if n.startswith("batch=")}


def read_ledger(spark: SparkSession, out: str, batch: str | None = None, folders: list[str] | None = None) -> DataFrame | None:
    """Rows of all batches but ``batch``, whatever wrote them; None when nothing is stored. ``folders`` are
    the prefixes to read, where there is an index."""
    plain, indexed = _batches(spark, f"{out}/fingerprints"), _batches(spark, f"{out}/ledger")
    if not (plain | indexed) - {batch}:
        return None
    rest = sorted(plain - indexed - {batch})
    found = spark.createDataFrame([], SCHEMA)
    if indexed - {batch}:
        # only the named folders are listed; a merged batch has none
        pattern = "*" if folders is None else "{" + ",".join(folders) + "}"
        fs, glob = _folder(spark, f"{out}/ledger/batch=*/prefix={pattern}")
        if fs.globStatus(glob):
            with many_folders(spark):
                found = spark.read.schema(SCHEMA).option("basePath", f"{out}/ledger").parquet(f"{out}/ledger/batch=*/prefix={pattern}")
            found = found if batch is None else found.filter(F.col("batch") != batch)
            found = found if folders is None else found.filter(F.col("prefix").isin(folders))
    if rest:
        flat = spark.read.schema(SCHEMA.rsplit(",", 1)[0]).option("basePath", f"{out}/fingerprints").parquet(*[f"{out}/fingerprints/batch={b}" for b in rest])
        flat = flat.withColumn("prefix", prefix_of(F.col("fingerprint")))
        found = found.unionByName(flat if folders is None else flat.filter(F.col("prefix").isin(folders)))
    return found


@contextmanager
def _values_pushed(spark: SparkSession, n: int):
    before = spark.conf.get(IN_CONF)
    spark.conf.set(IN_CONF, str(max(n, int(before))))
    try:
        yield
    finally:
        spark.conf.set(IN_CONF, before)


def _one_of(column: Column, values: list[str]) -> Column:
    """Lists of ``LISTED`` values, joined in pairs: a tree of small depth."""
    if len(values) <= LISTED:
        return column.isin(values)
    half = len(values) // 2
    return _one_of(column, values[:half]) | _one_of(column, values[half:])


def lookup(spark: SparkSession, out: str, batch: str | None, prints: DataFrame, values: int = LOOKUPS) -> DataFrame | None:
    """Rows of the other batches with a fingerprint of ``prints``; None when nothing is stored.

    The prefixes reach the driver, of which there are at most ``16 ** DIGITS``, and name the folders
    to read. Up to ``values`` fingerprints go along, for the readers' statistics and Bloom filters; more of them
    meet the folders' rows in a join.
    """
    keys = prints.select("fingerprint").distinct()
    folders = sorted(r[0] for r in keys.select(prefix_of(F.col("fingerprint")).alias("p")).distinct().collect())
    there = read_ledger(spark, out, batch, folders)
    if there is None:
        return None
    few = [r[0] for r in keys.limit(values + 1).collect()]
    if len(few) > values:
        return materialize(there.join(keys, "fingerprint", "left_semi"), "known")
    with _values_pushed(spark, LISTED):
        return materialize(there.filter(_one_of(F.col("fingerprint"), few)), "known")


def compact(spark: SparkSession, out: str, batches: Iterable[str]) -> str | None:
    """Merge the index folders of finished batches into one; a batch that may still be repeated must not be among them.

    The merged folder is written before the others are emptied, so a reader, or a restart in between,
    finds every row once or twice, which the ledger's joins do not mind.
    """
    names = sorted(set(batches) & (_batches(spark, f"{out}/ledger") | _batches(spark, f"{out}/fingerprints")))
    if not names:
        return None
    merged = f"merged-{uuid.uuid4().hex[:12]}"
    write_ledger(read_ledger(spark, out).filter(F.col("batch").isin(names)).drop("batch", "prefix"), out, merged)
    for name in names:
        fs, folder = _folder(spark, f"{out}/ledger/batch={name}")
        fs.delete(folder, True)
        if not name.startswith("merged-"):
            fs.create(_folder(spark, f"{out}/ledger/batch={name}/_merged")[1]).close()  # indexed, elsewhere
    return merged
