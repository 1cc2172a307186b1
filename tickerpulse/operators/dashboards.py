"""The dashboard panels as DataFrame queries over scored posts (``created`` in epoch seconds)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeparse import bucket_start


def in_time_range(posts: DataFrame, start: int, end: int, seconds: str = "created") -> DataFrame:
    """Posts from ``start`` to ``end``, both included, as epoch seconds."""
    return posts.where(F.col(seconds).between(start, end))


def total_posts(posts: DataFrame) -> DataFrame:
    return posts.agg(F.count(F.lit(1)).alias("value"))


def posts_per_term(posts: DataFrame) -> DataFrame:
    return posts.groupBy("search_term").agg(F.count(F.lit(1)).alias("total"))


def term_is(posts: DataFrame, term: str) -> DataFrame:
    return posts.where(F.col("search_term") == term)


def term_like(posts: DataFrame, pattern: str) -> DataFrame:
    return posts.where(F.col("search_term").like(pattern))


def progress_per_term(posts: DataFrame, targets: DataFrame) -> DataFrame:
    """Every target with the posts collected so far and the share reached."""
    counts = posts_per_term(posts).select("search_term", F.col("total").alias("value"))
    joined = targets.join(counts, "search_term", "left")
    value = F.coalesce("value", F.lit(0))
    return joined.select("search_term", value.alias("value"), "target", (value / F.col("target")).alias("progress"))


def posts_over_time(posts: DataFrame, width: int, by_term: bool = False) -> DataFrame:
    """Posts per time bucket (epoch seconds of its start), ordered; per term if asked."""
    keys: list[Column] = [bucket_start(F.col("created"), width).alias("time")]
    if by_term:
        keys.append(F.col("search_term"))
    counts = posts.groupBy(*keys).agg(F.count("id").alias("tweet_count"))
    return counts.orderBy("time", *(["search_term"] if by_term else []))


def polarity_series(posts: DataFrame) -> DataFrame:
    """Polarity of every post by time."""
    return posts.select(F.col("created").alias("time"), "polarity").orderBy("time")
