"""Session helpers: local builder for tests and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_CONF = "spark.checkpoint.dir"
LISTING_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def local_session(cpus: int | str = 8, app: str = "tracelake", memory: str = "8g") -> SparkSession:
    """Small local session for tests and bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder the cluster names.

    Only a local session, whose one machine is the driver's, may go without the setting; a
    temporary folder is then chosen and recorded, so that every later call agrees on it.
    """
    base = spark.conf.get(SHARED_DIR_CONF, None)
    if not base:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError(f"set {SHARED_DIR_CONF} to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tracelake-")
        spark.conf.set(SHARED_DIR_CONF, base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives executor loss."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def many_folders(spark: SparkSession) -> Iterator[None]:
    """Read folders of very many folders inside: they are listed by a few tasks per core, each
    taking many of them, where Spark's default is a task of its own for every folder up to 10,000."""
    before = spark.conf.get(LISTING_CONF, None)
    spark.conf.set(LISTING_CONF, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(LISTING_CONF) if before is None else spark.conf.set(LISTING_CONF, before)


def write_folders(df: DataFrame, path: str, *keys: str, order: tuple[str, ...] = ()) -> None:
    """Lines ``value`` as one text file per key, each in folders named by it, below a fresh path.

    Keys are dealt to all cores. In a mounted folder the tasks write the files themselves: Spark's
    writer starts several processes per file there to set its permissions, and the driver moves the
    files one by one. A file takes its name when it is complete, so a repeated task replaces it.
    Other stores get Spark's writer, with files moved by the tasks.
    """
    spark = df.sparkSession
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = df.repartition(parts, *keys).sortWithinPartitions(*keys, *order).select(*keys, "value")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toUri()
    if where.getScheme() != "file":
        rows.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(*keys).text(path)
        return
    home = where.getPath()
    os.makedirs(home)

    def run(batches):
        key, file, name = None, None, None
        for batch in batches:
            *named, lines = (c.to_pylist() for c in (*batch.columns[:-1], batch.column(len(keys)).cast(pa.large_binary())))
            for now, line in zip(zip(*named), lines):
                if file is None or now != key:
                    if file is not None:
                        file.close()
                        os.replace(file.name, name)
                    key = now
                    folder = "/".join([home, *(f"{k}={_folder_name(v)}" for k, v in zip(keys, now))])
                    os.makedirs(folder, exist_ok=True)
                    name = f"{folder}/part-0.txt"
                    file = open(f"{folder}/.part-0-{uuid.uuid4().hex}", "wb")
                file.write((line or b"") + b"\n")
        if file is not None:
            file.close()
            os.replace(file.name, name)
        yield from ()

    rows.mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()


def _folder_name(value) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if value is None or value == "" else quote(str(value), safe=" !$&'()+,;@~")
