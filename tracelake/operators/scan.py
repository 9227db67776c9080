"""Running values inside a session without putting a whole session into one task.

A window over ``session_id`` alone would sort every turn of a session in one task, and one
session may hold a large part of all turns. Here a session is cut into chunks of positions:

1. each chunk is reduced to one summary row (partial aggregation on the map side),
2. the summaries, smaller by the chunk length, get the carry from the chunks before,
3. a window over ``(session, chunk)`` adds the carry to the values inside the chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 65_536


def running(df: DataFrame, keys: list[str], order: list[str], *, chunk: Column | None = None,
            sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None,
            totals: dict[str, str] | None = None, inclusive: bool = False,
            coarse: str | None = None, carry_from: Column | None = None) -> DataFrame:
    """Add running columns per ``keys`` in the order of ``order``.

    ``sums`` maps an output to a summed expression, ``lasts`` to a position (a value that grows
    with the order) of which the latest non-null one is wanted, ``totals`` names the sum of a
    whole session (output -> sum). ``carry_from`` is true for all rows of sessions that may
    have more than one chunk: only those are read for the summaries.
    ``chunk`` defaults to the position divided by a fixed length; the chunks must be ordered
    like the rows. ``coarse`` names a field of a struct chunk by which the summaries of a
    session are themselves cut, for sessions of very many chunks (sums only).
    """
    sums, lasts, totals = sums or {}, lasts or {}, totals or {}
    chunk = F.floor(F.col(order[0]) / F.lit(CHUNK)) if chunk is None else chunk
    rows = df.withColumn("_chunk", chunk)
    for name, e in {**sums, **lasts}.items():
        rows = rows.withColumn(f"_v_{name}", e)

    summed = rows if carry_from is None else rows.filter(carry_from)
    summary = summed.groupBy(*keys, "_chunk").agg(
        *[F.coalesce(F.sum(f"_v_{n}"), F.lit(0)).alias(f"_s_{n}") for n in sums],
        *[F.max(f"_v_{n}").alias(f"_s_{n}") for n in lasts])
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    if coarse is None:
        carry = summary.select(
            *keys, "_chunk",
            *[F.sum(f"_s_{n}").over(before).alias(f"_c_{n}") for n in sums],
            *[F.max(f"_s_{n}").over(before).alias(f"_c_{n}") for n in lasts],
            *[F.sum(f"_s_{src}").over(whole).alias(out) for out, src in totals.items()])
    else:
        if lasts or totals:
            raise ValueError("a coarse level carries sums only")
        level = summary.withColumnRenamed("_chunk", "_fine")
        carry = running(level, keys, ["_fine"], chunk=F.col("_fine")[coarse],
                        sums={f"_c_{n}": F.col(f"_s_{n}") for n in sums}).select(
            *keys, F.col("_fine").alias("_chunk"), *[f"_c_{n}" for n in sums])
    if not totals:
        # most sessions have one chunk and need no carry: the join side stays tiny
        carry = carry.filter(
            F.coalesce(*[F.col(f"_c_{n}").cast("string") for n in {**sums, **lasts}]).isNotNull())

    here = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    out = rows.join(carry, [*keys, "_chunk"], "left")
    for n in sums:
        out = out.withColumn(n, F.coalesce(F.sum(f"_v_{n}").over(here), F.lit(0))
                             + F.coalesce(F.col(f"_c_{n}"), F.lit(0)))
    for n in lasts:
        out = out.withColumn(n, F.coalesce(F.max(f"_v_{n}").over(here),
                                           F.col(f"_c_{n}")))
    return out.select(*df.columns, *sums, *lasts, *totals)


#: Up to this rank Spark itself cuts each task's rows to the wanted ones before the shuffle.
NATIVE_RANKS = 1000


def first_rows(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every key in the given (total) order.

    A key may hold most rows. For larger ``n`` its rows are first ranked in parts, about
    ``sqrt(rows / n)`` of them by the measured count, and only the first ``n`` of each part
    meet: parts and candidates both stay near ``sqrt(rows * n)`` rows.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    if n > NATIVE_RANKS:
        sizes = df.groupBy(*keys).agg(F.ceil(F.sqrt(F.count(F.lit(1)) / F.lit(n))).cast("int").alias("_parts"))
        names = [c for c in df.columns if c not in keys]
        parted = df.join(sizes, keys).withColumn("_part", F.pmod(F.xxhash64(*names), F.col("_parts")))
        within = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))
        df = parted.withColumn("_n", within).filter(F.col("_n") <= n).select(*df.columns)
    return df.withColumn("_n", rank).filter(F.col("_n") <= n).drop("_n")
