"""Exploratory reports. Each covers all companies, terms or tickers in one grouped plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .series import number_rows

SIGNS = ("positive", "negative", "neutral")


def share(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage of each value of a column; nulls take no part."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percent", F.col("n") * 100.0 / total)


def sentiment_share(df: DataFrame) -> DataFrame:
    """Percentage of each sentiment within its company."""
    counts = df.where(F.col("company_name").isNotNull()).groupBy("company_name", "sentiment").agg(
        F.count(F.lit(1)).alias("n"))
    # at most three rows per company are left to window over
    percent = F.col("n") * 100.0 / F.sum("n").over(W.partitionBy("company_name"))
    return counts.select("company_name", "sentiment", percent.alias("percent"))


def sentiment_share_of_rollup(daily: DataFrame, companies: DataFrame) -> DataFrame:
    """Percentage of posts by sign per company, one row per (company, sign), from the rollup."""
    sums = daily.groupBy("search_term").agg(
        *[(F.sum(f"{s}_count") * 100.0 / F.sum("count")).alias(s) for s in SIGNS])
    long = sums.unpivot("search_term", list(SIGNS), "sentiment", "percent")
    named = long.join(companies, long["search_term"] == companies["ticker_symbol"])
    return named.select("company_name", "sentiment", "percent")


def _exact_sum(column: str) -> Column:
    """Sum of scores, which have four decimals: exact, so that no order of summing decides a rank."""
    return F.sum(F.col(column).cast("decimal(18,4)")).cast("double").alias(column)


def score_per_writer(df: DataFrame) -> DataFrame:
    return df.groupBy("writer").agg(_exact_sum("compound"))


def worst_writers(df: DataFrame, n: int = 10) -> DataFrame:
    """The n writers with the lowest summed score; ties in writer order."""
    return score_per_writer(df).orderBy("compound", "writer").limit(n)


def first_company_of_worst_writers(df: DataFrame, row_id: str, n: int = 10) -> DataFrame:
    """The n lowest-scored writers with the company of their first post, in one aggregate."""
    per_writer = df.groupBy("writer").agg(
        _exact_sum("compound"), F.min_by("company_name", row_id).alias("company"))
    return per_writer.orderBy("compound", "writer").limit(n).select(F.col("writer").alias("author"), "company")


def companies_trolled(df: DataFrame, row_id: str, n: int = 10) -> DataFrame:
    """How often each company is the first target of one of the worst writers."""
    return first_company_of_worst_writers(df, row_id, n).groupBy("company").agg(
        F.count(F.lit(1)).alias("count"))


def score_per_day(df: DataFrame) -> DataFrame:
    return df.groupBy("day_date").agg(_exact_sum("compound"))


def posts_per_day_and_company(df: DataFrame) -> DataFrame:
    return df.where(F.col("company_name").isNotNull()).groupBy("day_date", "company_name").agg(
        F.count(F.lit(1)).alias("posts"))


def sentiment_by_days_passed(df: DataFrame) -> DataFrame:
    """Positive and negative posts per company and day number."""
    return df.where(F.col("company_name").isNotNull()).groupBy("company_name", "day_passed").agg(
        F.sum("positive").alias("positive"), F.sum("negative").alias("negative"))


def close_by_days_passed(prices: DataFrame) -> DataFrame:
    """Summed closing value per ticker and day number."""
    return prices.groupBy("ticker_symbol", "day_passed").agg(F.sum("close_value").alias("close_value"))


def positional_sample(df: DataFrame, order: str, width: int = 65_536, head: int = 10_001,
                      slices: tuple = ((200_000, 2_010_000), (2_000_000, 2_001_000)),
                      tail: int = 10_000) -> DataFrame:
    """First rows, then slices by position (ends included), then last rows, one after another.

    Rows in several parts appear once per part (``part`` 0, 1, ...). ``order`` is a whole-number
    column that gives the row order.
    """
    rn, n = F.col("rn"), F.col("n_rows")
    parts = [rn < head, *[(rn >= a) & (rn <= b) for a, b in slices], rn >= n - F.lit(tail)]
    hits = F.array_compact(F.array(*[F.when(hit, F.lit(i)) for i, hit in enumerate(parts)]))
    placed = number_rows(df, [], [order], F.floor(F.col(order) / F.lit(width)), levels=2)
    return placed.withColumn("part", F.explode(hits)).drop("rn", "n_rows")
