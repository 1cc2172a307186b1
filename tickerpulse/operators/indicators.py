"""Technical indicators, targets and splits over price series.

Input: one row per (symbol, dt), where dt is a date or, for finer bars, a timestamp. Every function
works on all symbols at once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .series import CHUNK_ROWS, calendar_bucket, chunk_window, in_chunks, number_rows, own_rows

KEY, DAY = "symbol", "dt"

# The largest double halved this often is below the smallest one: an older value adds exactly zero.
HALVINGS = 2100
# Powers up to e to this stay well inside the range of a double.
LARGEST_POWER = 500.0
# Spans up to this many times the shortest share their blocks.
ALIKE = 4


def numbered(prices: DataFrame, keys: Sequence[str] = (KEY,), day: str = DAY) -> DataFrame:
    """Rows numbered by day. Rows of the same key and day stand in the order of their other columns
    (by name), whatever the partitioning; rows equal in all of them are interchangeable."""
    ties = sorted(f.name for f in prices.schema.fields
                  if f.name not in (*keys, day) and isinstance(f.dataType, T.AtomicType))
    return number_rows(prices, keys, [day, *ties], *calendar_bucket(prices, day))


def _mean_of_last(column: Column, n: int, window: WindowSpec) -> Column:
    """Mean of the last n rows, null until there are n values."""
    frame = window.rowsBetween(-n + 1, 0)
    return F.when(F.count(column).over(frame) == n, F.avg(column).over(frame))


def _forgetting(span: int) -> float:
    """How much weight, as a logarithm, a value loses per row."""
    return -math.log(1.0 - 2.0 / (span + 1))


def memory_rows(span: int) -> int:
    """Rows after which an exponential mean of this span has forgotten any value a double can hold."""
    return math.ceil(HALVINGS * math.log(2) / _forgetting(span)) if span > 1 else 0


def _chunk_rows(reach: int) -> int:
    """Chunks twice as long as what they look back to, so that copies stay under half of the rows."""
    return max(CHUNK_ROWS, 2 * reach)


def _alike(spans: dict[str, int]) -> list[dict[str, int]]:
    """Spans in groups that share blocks: a short one allows short blocks only, of which a much
    longer one would have to look back to hundreds."""
    groups: list[dict[str, int]] = []
    for name, span in sorted(spans.items(), key=lambda s: s[1]):
        shortest = min((s for s in groups[-1].values() if s > 1), default=span) if groups else 0
        if groups and span <= ALIKE * shortest:
            groups[-1][name] = span
        else:
            groups.append({name: span})
    return groups


def _block_length(spans: Sequence[int]) -> int:
    """A quarter of the longest memory, or less where powers of the shortest would overflow."""
    spans = [s for s in spans if s > 1]
    if not spans:
        return 1
    longest = math.ceil(memory_rows(max(spans)) / 4)
    return max(1, min(longest, math.floor(LARGEST_POWER / _forgetting(min(spans)))))


def _ema(chunked: DataFrame, column: str, spans: dict[str, int], block: int,
         keys: Sequence[str]) -> DataFrame:
    """Exponential means of a column inside chunks that carry enough earlier rows, cut into blocks
    of ``block`` rows.

    The recurrence y = a*x + (1-a)*y_prev is solved per block of rows: a running sum scaled by
    powers of (1-a) gives the mean with nothing carried in, and what the few preceding blocks that
    still matter leave behind is carried in by the same recurrence over blocks.
    """
    rn = F.col("rn")
    place = rn % F.lit(block)
    in_block = W.partitionBy(*keys, "_chunk", "_block").orderBy("rn").rowsBetween(W.unboundedPreceding, 0)
    blocks = W.partitionBy(*keys, "_chunk").orderBy("_block")
    local, full = {}, {}
    for name, span in spans.items():
        if span == 1:
            full[name] = F.col(column)
            continue
        alpha = 2.0 / (span + 1)
        keep = 1.0 - alpha
        start = F.when(rn == 0, F.col(column)).otherwise(F.col(column) * F.lit(alpha))
        scaled = start * F.pow(F.lit(keep), -place)
        local[f"_{name}"] = F.sum(scaled).over(in_block) * F.pow(F.lit(keep), place)
        carried = F.lit(0.0)
        for back in range(math.ceil(memory_rows(span) / block), 0, -1):
            # the last value of the block that lies ``back`` blocks earlier
            end = F.max(F.when(place == block - 1, F.col(f"_{name}"))).over(blocks.rangeBetween(-back, -back))
            carried = F.coalesce(end, F.lit(0.0)) + carried * F.lit(keep**block)
        full[name] = F.col(f"_{name}") + carried * F.pow(F.lit(keep), place + F.lit(1))
    return chunked.withColumns(local).withColumns(full).drop(*local)


def with_ema(prices: DataFrame, spans: dict[str, int], column: str = "close",
             chunk: int | None = None) -> DataFrame:
    """Add exponential means (no bias correction); ``spans`` maps new column to span.

    Rows without a value take no part in the recurrence and are left out.
    """
    rows = numbered(prices.where(F.col(column).isNotNull()))
    reach = max(memory_rows(s) for s in spans.values())
    out = in_chunks(rows, [KEY], before=reach, chunk=chunk or _chunk_rows(reach))
    for group in _alike(spans):
        block = _block_length(list(group.values()))
        out = _ema(out.withColumn("_block", F.floor(F.col("rn") / F.lit(block))), column, group, block, [KEY])
    return own_rows(out).drop("rn", "n_rows")


def _macd(chunked: DataFrame, column: str, short: int, long: int, signal: int, block: int) -> DataFrame:
    means = _ema(chunked, column, {"_short": short, "_long": long}, block, [KEY])
    line = means.withColumn("MACD", F.col("_short") - F.col("_long")).drop("_short", "_long")
    return _ema(line, "MACD", {"Signal_Line": signal}, block, [KEY])


def macd_reach(long: int, signal: int) -> int:
    return memory_rows(long) + memory_rows(signal)


def with_macd(prices: DataFrame, column: str = "close", short: int = 12, long: int = 26,
              signal: int = 9, chunk: int | None = None) -> DataFrame:
    """Add MACD (short minus long mean) and Signal_Line (mean of MACD)."""
    rows = numbered(prices.where(F.col(column).isNotNull()))
    block, reach = _block_length([short, long, signal]), macd_reach(long, signal)
    chunked = in_chunks(rows, [KEY], before=reach, chunk=chunk or _chunk_rows(reach), block=block)
    return own_rows(_macd(chunked, column, short, long, signal, block)).drop("rn", "n_rows")


def with_sma(prices: DataFrame, period: int = 30, column: str = "close",
             chunk: int = CHUNK_ROWS) -> DataFrame:
    """Add SMA, the mean of the last ``period`` rows."""
    chunked = in_chunks(numbered(prices), [KEY], before=period - 1, chunk=chunk)
    window = chunk_window([KEY])
    out = chunked.withColumn("SMA", _mean_of_last(F.col(column), period, window))
    return own_rows(out).drop("rn", "n_rows")


def _rsi(chunked: DataFrame, column: str, period: int) -> DataFrame:
    window = chunk_window([KEY])
    delta = F.col(column) - F.lag(column).over(window)
    moves = chunked.withColumn("_delta", delta).withColumns({
        "_up": F.when(F.col("_delta").isNotNull(), F.greatest(F.col("_delta"), F.lit(0.0))),
        "_down": F.when(F.col("_delta").isNotNull(), F.least(F.col("_delta"), F.lit(0.0))),
    })
    means = moves.withColumns({
        "_gain": _mean_of_last(F.col("_up"), period, window),
        "_loss": F.abs(_mean_of_last(F.col("_down"), period, window)),
    })
    # no loss at all is 100, no movement at all is undefined
    ratio = F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + F.try_divide("_gain", "_loss"))
    rsi = F.when((F.col("_loss") == 0) & (F.col("_gain") > 0), F.lit(100.0)).otherwise(ratio)
    return means.withColumn("RSI", rsi).drop("_delta", "_up", "_down", "_gain", "_loss")


def with_rsi(prices: DataFrame, period: int = 14, column: str = "close",
             chunk: int = CHUNK_ROWS) -> DataFrame:
    """Add RSI from simple means of the ups and downs of the last ``period`` rows."""
    chunked = in_chunks(numbered(prices), [KEY], before=period, chunk=chunk)
    return own_rows(_rsi(chunked, column, period)).drop("rn", "n_rows")


def with_target(prices: DataFrame, ahead: int = 7, column: str = "close",
                chunk: int = CHUNK_ROWS) -> DataFrame:
    """Add Target: 1 if the value ``ahead`` rows later is higher, else 0 (also at the end)."""
    chunked = in_chunks(numbered(prices), [KEY], before=0, after=ahead, chunk=chunk)
    later = F.lead(column, ahead).over(chunk_window([KEY]))
    out = chunked.withColumn("Target", F.when(later > F.col(column), 1).otherwise(0))
    return own_rows(out).drop("rn", "n_rows")


def with_delta(prices: DataFrame, column: str = "close", key: str = KEY, day: str = DAY,
               chunk: int = CHUNK_ROWS) -> DataFrame:
    """Add the change against the previous row, 0 on the first."""
    chunked = in_chunks(numbered(prices, [key], day), [key], before=1, chunk=chunk)
    change = F.col(column) - F.lag(column).over(chunk_window([key]))
    out = chunked.withColumn("delta_close_value",
                             F.when(F.col("rn") == 0, F.lit(0.0)).otherwise(change))
    return own_rows(out).drop("rn", "n_rows")


def with_split(rows: DataFrame, percent: float = 80.0) -> DataFrame:
    """Add split: the first ``percent`` of each symbol's rows are training, the rest testing."""
    placed = numbered(rows)
    last_training = F.floor(F.lit(percent / 100.0) * F.col("n_rows"))
    side = F.when(F.col("rn") < last_training, "training").otherwise("testing")
    return placed.withColumn("split", side).drop("rn", "n_rows")


def with_index(rows: DataFrame) -> DataFrame:
    """Add Index, the 0-based place of the row in its series."""
    return numbered(rows).withColumnRenamed("rn", "Index").drop("n_rows")


def between_days(df: DataFrame, start: str, end: str, day: str = DAY) -> DataFrame:
    """Rows from ``start`` up to, not including, ``end``."""
    return df.where((F.col(day) >= F.lit(start).cast("date")) & (F.col(day) < F.lit(end).cast("date")))


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with any null; NaN in a floating column counts as null."""
    floats = {
        f.name: F.when(~F.isnan(F.col(f.name)), F.col(f.name))
        for f in df.schema.fields if f.dataType.typeName() in ("double", "float")
    }
    return df.withColumns(floats).dropna("any") if floats else df.dropna("any")


FEATURES = ("close", "MACD", "Signal_Line", "RSI", "SMA", "EMA")

# Date ranges of the model-building and verification sets.
BUILD_RANGE = ("2016-01-01", "2021-07-24")
VERIFY_RANGE = ("2021-07-24", "2021-08-29")


def indicator_frame(prices: DataFrame, column: str = "close", chunk: int | None = None) -> DataFrame:
    """All indicators in one chunk layout: MACD, Signal_Line, RSI, SMA(30), EMA(20)."""
    rows = numbered(prices.where(F.col(column).isNotNull()))
    block, reach = _block_length([12, 26, 9, 20]), macd_reach(26, 9)
    chunked = in_chunks(rows, [KEY], before=reach, chunk=chunk or _chunk_rows(reach), block=block)
    out = _ema(_macd(chunked, column, 12, 26, 9, block), column, {"EMA": 20}, block, [KEY])
    out = _rsi(out, column, 14)
    out = out.withColumn("SMA", _mean_of_last(F.col(column), 30, chunk_window([KEY])))
    return own_rows(out).drop("rn", "n_rows")


def purge_tail(frame: DataFrame, end: str, rows: int) -> DataFrame:
    """Drop the last ``rows`` rows before ``end`` of each symbol, whose targets look past it."""
    before = numbered(between_days(frame, "0001-01-01", end))
    keep = before.where(F.col("rn") < F.col("n_rows") - F.lit(rows)).drop("rn", "n_rows")
    return keep.unionByName(frame.where(F.col(DAY) >= F.lit(end).cast("date")))
