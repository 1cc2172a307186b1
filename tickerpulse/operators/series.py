"""Ordered work on long series without one task per series.

A plain ``partitionBy(key)`` window puts a whole series into one task, which fails as soon as
one key holds a large share of the rows. Here rows are numbered through a tree of counts, cut
into chunks of fixed length, and each chunk carries copies of the few rows before and after it
that its windows reach. All windows of a chunk then run in one shuffle partition of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

CHUNK_ROWS = 8192


GROUP_BITS = 10  # buckets whose running total one task takes: 2 ** 10


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, levels: int = 0,
                cut: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """Add ``rn`` (0-based place in the series) and ``n_rows`` (its length).

    ``bucket`` must not decrease along ``order`` (the month of a date, a range of ids). Only one
    bucket of one key is ever sorted together. The rows are written once (``cut``) with their places
    in the bucket; counts and rows are then read from there, so the input is computed once. The
    counts are added up over the buckets of a key in one task, or, with ``levels``, over 1024 of them, over
    1024 such groups and so on (whole-number buckets only).
    Rows with a null key or bucket have no place in a series and are left out.
    """
    keys = list(keys)
    tagged = df.withColumn("_bucket", bucket)
    in_bucket = W.partitionBy(*keys, "_bucket").orderBy(*order)
    placed = cut(tagged.withColumn("_place", F.row_number().over(in_bucket)))
    counts = placed.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    return (
        placed.join(_offsets(counts, keys, levels), [*keys, "_bucket"])
        .withColumn("rn", F.col("_before") + F.col("_place") - F.lit(1))
        .drop("_bucket", "_place", "_before")
    )


def _offsets(counts: DataFrame, keys: list[str], levels: int) -> DataFrame:
    """``keys``, _bucket, rows of the key before it (_before) and in all (n_rows), from counts (_n)."""
    def running(window: W) -> Column:
        return F.coalesce(F.sum("_n").over(window.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))

    if not levels:
        # without keys the groups of the last level, a few hundred rows, meet in one task
        series = W.partitionBy(*keys) if keys else W.partitionBy(F.col("_bucket") * F.lit(0))
        return counts.select(*keys, "_bucket", running(series).alias("_before"), F.sum("_n").over(series).alias("n_rows"))
    grouped = counts.withColumn("_group", F.shiftright(F.col("_bucket").cast("long"), GROUP_BITS))
    groups = grouped.groupBy(*keys, F.col("_group").alias("_bucket")).agg(F.sum("_n").alias("_n"))
    above = _offsets(groups, keys, levels - 1).withColumnsRenamed({"_bucket": "_group", "_before": "_above"})
    return (grouped.withColumn("_own", running(W.partitionBy(*keys, "_group"))).join(above, [*keys, "_group"])
            .select(*keys, "_bucket", (F.col("_own") + F.col("_above")).alias("_before"), "n_rows"))


def calendar_bucket(df: DataFrame, time: str = "dt") -> tuple[Column, int]:
    """A bucket that stays small and the levels its counts take: months for dates, of which a century
    of one key has 1 200; minutes for timestamps, added up over 17 hours and two years first."""
    if isinstance(df.schema[time].dataType, T.DateType):
        return F.year(time) * F.lit(12) + F.month(time), 0
    return F.floor(F.unix_micros(F.col(time).cast("timestamp")) / F.lit(60_000_000)), 2


def in_chunks(numbered: DataFrame, keys: Sequence[str], before: int, after: int = 0, chunk: int = CHUNK_ROWS,
              block: int | None = None) -> DataFrame:
    """Give every row its chunk, and copies of it to the chunks that look back or ahead to it.

    A chunk holds ``chunk`` rows of its own plus up to ``before`` and ``after`` copies; ``_own``
    tells them apart. ``_block`` numbers runs of ``block`` rows (the chunk length if not given),
    and every window sorts by it first, so that one sort serves them all.
    """
    rn = F.col("rn")
    first = F.greatest(F.floor((rn - F.lit(after)) / F.lit(chunk)), F.lit(0))
    last = F.floor((rn + F.lit(before)) / F.lit(chunk))
    # no chunk starts beyond the end of the series
    last = F.least(last, F.floor((F.col("n_rows") - F.lit(1)) / F.lit(chunk)))
    copies = numbered.withColumn("_chunk", F.explode(F.sequence(first, last)))
    placed = copies.withColumns({
        "_own": F.col("_chunk") == F.floor(rn / F.lit(chunk)), "_block": F.floor(rn / F.lit(block or chunk))})
    # stated outright: a plan already partitioned by the keys alone would otherwise be taken as is
    return placed.repartition(*[F.col(k) for k in keys], F.col("_chunk"))


def own_rows(chunked: DataFrame) -> DataFrame:
    """Drop the copies."""
    return chunked.where("_own").drop("_own", "_chunk", "_block")


def chunk_window(keys: Sequence[str]) -> W:
    return W.partitionBy(*keys, "_chunk").orderBy("_block", "rn")
