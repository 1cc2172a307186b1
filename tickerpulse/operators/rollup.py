"""Daily polarity per search term."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeparse import day_of_epoch, seconds_of


def distinct_rows(scored: DataFrame) -> DataFrame:
    """Whole-row distinct of scored posts, without their text.

    Text takes part through its SHA-256 digest, so equal rows are still found by all columns
    while the shuffle carries 32 bytes instead of the text.
    """
    return scored.select(
        "t_key", "created", "search_term", "id", "polarity",
        F.unhex(F.sha2(F.col("processed_text"), 256)).alias("text_digest"),
    ).distinct()


def daily_polarity(scored: DataFrame) -> DataFrame:
    """Posts, summed polarity and counts by sign per (date, search_term).

    A null polarity counts as a post and under no sign; a time that cannot be read gives a null date. The aggregate is combined before the
    shuffle, so a frequent term or day sends one row per task.
    """
    polarity = F.col("polarity")
    return (
        scored.groupBy(day_of_epoch(seconds_of(scored)).alias("date"), "search_term")
        .agg(
            F.count("t_key").alias("count"),
            F.sum("polarity").alias("agg_polarity"),
            F.count_if(polarity > 0).alias("positive_count"),
            F.count_if(polarity < 0).alias("negative_count"),
            F.count_if(polarity == 0).alias("neutral_count"),
        )
    )
