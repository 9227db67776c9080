"""Gold tables: cards, turns, fingerprints, vectors, audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("cards", "steps", "turns", "fingerprints", "vectors", "audit")


def write_gold(tables: dict[str, DataFrame], path: str, batch: str | None = None,
               partition_by: tuple[str, ...] = ()) -> dict[str, str]:
    """Write every table below ``path``. With ``batch`` each write replaces exactly the
    folder of that batch, so repeating a batch leaves one copy."""
    out = {}
    for name, df in tables.items():
        if name not in TABLES:
            raise ValueError(f"unknown gold table {name!r}")
        target = f"{path}/{name}" + (f"/batch={batch}" if batch is not None else "")
        writer = df.write.mode("overwrite")
        if partition_by and set(partition_by) <= set(df.columns):
            writer = writer.partitionBy(*partition_by)
        writer.parquet(target)
        out[name] = f"{path}/{name}"
    return out


def read_gold(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}")
