"""From daily prices to the frames the classifiers are trained and checked on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators import indicators as ind
from ..session import cut_lineage


def labelled_frame(prices: DataFrame, cut: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """Indicators, complete rows only, then the target over the rows that are left.

    The target numbers the rows anew, so the indicators are written once (``cut``) rather than
    computed for the counts and again for the rows.
    """
    complete = ind.drop_incomplete(ind.indicator_frame(prices))
    return ind.with_target(cut(complete))


def build_set(frame: DataFrame, dates: tuple[str, str] = ind.BUILD_RANGE, purge: int = 0) -> DataFrame:
    """Model-building rows. ``purge`` drops that many last rows per symbol: their targets look
    past the end of the range."""
    rows = ind.purge_tail(frame, dates[1], purge) if purge else frame
    return ind.between_days(rows, *dates).select(ind.KEY, ind.DAY, *ind.FEATURES, "Target")


def verification_set(frame: DataFrame, dates: tuple[str, str] = ind.VERIFY_RANGE) -> DataFrame:
    """Rows held back for verification, with their 0-based Index per symbol."""
    rows = ind.between_days(frame, *dates).select(ind.KEY, ind.DAY, *ind.FEATURES, "Target")
    return ind.with_index(rows)
