"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source with a share ``w`` of the target corpus and ``n`` of ``N`` rows gets the mean
repetition rate ``w * size / n``, where ``size`` is the wanted number of rows (by default
``N``). Each row draws a uniform number from a hash of seed and id, inverts the Poisson
distribution of its source's rate, and is exploded by that count. Rows are then ordered by a
hash of seed, id and copy, which shuffles all sources together and is the same on every run. The hash is
uniform, so its leading digits name a row's partition; nothing is sampled or read twice for the order.

Hot sources need no care: counts are taken with map-side combine, and the table of sources
(one row each, with its distribution) is stored first, so that Spark broadcasts it only while
its measured size is below the session's threshold and joins by shuffle beyond.

Defined results: sources without a weight share ``1`` with all others if no weights are given;
with weights, a source that is not named gets none; a null source is a source of its own,
named ''; rows with equal ids draw alike (a null id draws by its text); an empty table gives
no rows; other columns are kept, whatever their names; those named like an output, in any case, are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.session import materialize

#: 52 bits of the digest give the uniform number.
DIGITS = 13


def _uniform(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key), 1, DIGITS), 16, 10).cast("long") / F.lit(float(1 << 4 * DIGITS))


def rates(docs: DataFrame, weights: dict[str, float] | None = None, size: int | None = None,
          source: str = "source", temperature: float = 0.5) -> DataFrame:
    """One row per source: ``source, n_rows, rate`` and ``cdf``, the distribution's steps.

    Without weights, a source's weight is its row count to the power ``temperature``.
    """
    counted = docs.groupBy(F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source")).agg(F.count("*").alias("n_rows"))
    if weights is None:
        weighted = counted.withColumn("_w", F.pow(F.col("n_rows").cast("double"), F.lit(temperature)))
    else:
        named = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else F.lit(None).cast("map<string,double>")
        weighted = counted.withColumn("_w", F.coalesce(F.element_at(named, F.col("source")).cast("double"), F.lit(0.0)))
    counted = materialize(weighted, "sources")
    weight, rows = counted.agg(F.sum("_w"), F.sum("n_rows")).first()
    wanted = float((rows if size is None else size) or 0)
    share = counted.withColumn("rate", F.col("_w") / F.lit(weight) * wanted / F.col("n_rows") if weight else F.lit(0.0))
    # beyond rate + 12 * sqrt(rate) + 40 the tail is below a uniform number's last bit
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 40).cast("int")
    steps = F.expr("""aggregate(sequence(1, last), named_struct('l', -rate, 'c', array(exp(-rate))),
        (a, k) -> named_struct('l', a.l + ln(rate) - ln(k),
                               'c', concat(a.c, array(element_at(a.c, -1) + exp(a.l + ln(rate) - ln(k))))), a -> a.c)""")
    return share.withColumn("last", last).select(
        "source", "n_rows", "rate", F.when(F.col("rate") > 0, steps).otherwise(F.array(F.lit(1.0))).alias("cdf"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, size: int | None = None, seed: int = 0,
        doc_id: str = "doc_id", source: str = "source", text: str = "text", temperature: float = 0.5) -> DataFrame:
    """The rows of ``docs``, each as often as drawn, in the order of ``shuffle_key``; ``copy`` counts from 0."""
    outputs = ("copy", "rate", "shuffle_key")
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    kept = [c for c in docs.columns if c.lower() not in outputs]
    docs = docs.toDF(*at.values())   # no name of the input can meet one of ours
    table = materialize(rates(docs, weights, size, at[source], temperature), "rates").select("source", "rate", "cdf")
    ident = F.coalesce(F.col(at[doc_id]).cast("string"), F.md5(F.coalesce(F.col(at[text]).cast("string"), F.lit(""))))
    rows = docs.withColumn("key", F.concat(F.lit(f"{seed}:"), ident)).withColumn("source", F.coalesce(F.col(at[source]).cast("string"), F.lit("")))
    rows = rows.join(table, "source")
    u = _uniform(F.col("key"))
    # the count is the number of steps at or below u; the array is sorted
    rows = rows.withColumn("n", F.size(F.filter("cdf", lambda c: c <= u)))
    rows = rows.filter("n > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rows = rows.withColumn("shuffle_key", F.md5(F.concat("key", F.lit(":"), F.col("copy").cast("string"))))
    rows = rows.select(*[at[c] for c in kept], "copy", "rate", "shuffle_key")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.conv(F.substring("shuffle_key", 1, DIGITS), 16, 10).cast("double") / F.lit(float(1 << 4 * DIGITS))
    rows = rows.repartitionById(parts, F.floor(place * parts).cast("int")).sortWithinPartitions("shuffle_key", "copy")
    return rows.toDF(*kept, *outputs)
