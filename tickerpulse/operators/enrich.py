"""Lookups and joins. None carries a broadcast hint: Spark broadcasts a side only after it has
measured it, and otherwise falls back to a sort-merge join that it splits where keys are skewed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalize_ticker(ticker: Column) -> Column:
    """Both share classes count as GOOG."""
    return F.when(ticker == "GOOGL", F.lit("GOOG")).otherwise(ticker)


def clamp(value: Column, bound: float = 10_000) -> Column:
    limited = F.greatest(F.least(value, F.lit(bound)), F.lit(-bound))
    return F.when(value.isNotNull(), limited)


def last_value_per_key(table: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row per key, holding the value of the last row: what filling a map leaves."""
    return table.groupBy(key).agg(F.max_by(value, order).alias(value))


def attach_ticker(posts: DataFrame, tickers: DataFrame, order: str, key: str = "tweet_id") -> DataFrame:
    """Posts with their ticker: last one wins, GOOGL read as GOOG, ``""`` when unknown."""
    lookup = last_value_per_key(
        tickers.select(key, normalize_ticker(F.col("ticker_symbol")).alias("ticker_symbol"), order),
        key, "ticker_symbol", order)
    joined = posts.join(lookup, key, "left")
    return joined.withColumn("ticker_symbol", F.coalesce("ticker_symbol", F.lit("")))


def attach_company(posts: DataFrame, tickers: DataFrame, companies: DataFrame, order: str,
                   key: str = "tweet_id") -> DataFrame:
    """Posts with their company name: ticker to name, then post to name; null when unknown."""
    named = tickers.join(companies, "ticker_symbol", "left").select(key, "company_name", order)
    return posts.join(last_value_per_key(named, key, "company_name", order), key, "left")


def map_names(df: DataFrame, names: DataFrame, key: str, value: str) -> DataFrame:
    """Dictionary lookup; unknown codes give null."""
    return df.join(names.select(key, value), key, "left")


def canonical_term(df: DataFrame, instruments: DataFrame, column: str = "search_term") -> DataFrame:
    """Add ``ticker``: posts name an instrument by its ticker or by its search term."""
    vocabulary = instruments.select(
        F.explode(F.array_compact(F.array("ticker", "term"))).alias("_name"), "ticker")
    plain = df.withColumn("_name", normalize_ticker(F.col(column)))
    return plain.join(vocabulary, "_name", "left").drop("_name")


def daily_by_ticker(daily: DataFrame, instruments: DataFrame) -> DataFrame:
    """Daily polarity per (date, ticker): rows under an instrument's two names are added up."""
    sums = ["count", "agg_polarity", "positive_count", "negative_count", "neutral_count"]
    named = canonical_term(daily, instruments).where(F.col("ticker").isNotNull())
    return named.groupBy("date", "ticker").agg(*[F.sum(c).alias(c) for c in sums])


def merge_prices_polarity(prices: DataFrame, daily: DataFrame, instruments: DataFrame) -> DataFrame:
    """Prices (symbol, dt, ...) joined to the daily polarity of the same instrument and day.

    One join for all symbols; rows with any null are left out on both sides first.
    """
    listed = instruments.where(F.col("symbol").isNotNull()).select(
        "symbol", "ticker", F.col("term").alias("search_term"))
    by_symbol = daily_by_ticker(daily.dropna("any"), instruments).join(listed, "ticker").drop("ticker")
    return prices.dropna("any").join(by_symbol.withColumnRenamed("date", "dt"), ["symbol", "dt"])


def join_prices_by_ticker(daily: DataFrame, prices: DataFrame) -> DataFrame:
    """Daily polarity joined to prices on (date, term) = (day_date, ticker), score clamped."""
    joined = daily.join(
        prices, (daily["date"] == prices["day_date"]) & (daily["search_term"] == prices["ticker_symbol"]))
    return joined.withColumn("agg_polarity2", clamp(F.col("agg_polarity")))


def join_day_scores(day_scores: DataFrame, prices: DataFrame) -> DataFrame:
    """Score of the day next to every price row of that day."""
    return day_scores.join(prices, "day_date")


def unmatched_days(day_scores: DataFrame, prices: DataFrame) -> DataFrame:
    """What a full outer join on ``day_date`` leaves without a partner, marked with its side.

    Two anti joins give the same rows, and unlike a full outer join they can be broadcast or
    split where one day holds most of the prices. The second needs the days only, so nothing
    that goes into the scores is computed for it.
    """
    days = prices.select("day_date").distinct()
    left = day_scores.join(days, "day_date", "left_anti").withColumn("_merge", F.lit("left_only"))
    right = prices.join(day_scores.select("day_date"), "day_date", "left_anti").withColumn(
        "_merge", F.lit("right_only"))
    return left.unionByName(right, allowMissingColumns=True)


def derived_prices(prices: DataFrame) -> DataFrame:
    """Add day range, day gain and traded value."""
    return prices.withColumns({
        "fluctuation": F.col("high_value") - F.col("low_value"),
        "price_gain": F.col("close_value") - F.col("open_value"),
        "total_valuation_EOD": F.col("volume") * F.col("close_value"),
    })
