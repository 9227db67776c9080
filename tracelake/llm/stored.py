"""Intermediate tables written with small Arrow batches.

A batch between Spark and a Python worker holds up to 64 MB by default, once on either side.
Rows with sets, signatures or compressed texts are large, so those steps use smaller ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tracelake.session import materialize

BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = str(8 << 20)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back; the session's batch size is as before afterwards."""
    conf = df.sparkSession.conf
    before = conf.get(BATCH_CONF)
    conf.set(BATCH_CONF, BATCH_BYTES)
    try:
        return materialize(df, label)
    finally:
        conf.set(BATCH_CONF, before)
