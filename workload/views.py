"""Stand-ins for the collection's inputs, derived from the given tables as a whole.

posts      one per document, whole text, with hashtags and a link added
scored     scored posts at rest, one per event
prices     daily open/high/low/close/volume per symbol, from orders
tickers    (post id, ticker) rows in file order, from events; ids repeat
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerpulse.functions.lexicon import Lexicon
from tickerpulse.schemas import INSTRUMENTS, inline_table, instruments

# The text is in invented words; these occur in it.
LEXICON = Lexicon.of(
    {"that": 1.9, "with": 1.3, "thing": 2.4, "thble": 3.1,
     "was": -1.5, "from": -2.1, "this": -0.8, "are": -1.2},
    {"thon": 0.293, "than": -0.293},
    ["for"],
)
STOPWORDS = ("that", "with", "the", "was", "from", "this", "are", "for", "and", "les", "der", "los", "que")

POST_TERMS = ("TSLA", "microsoft", "AMZN", "apple", "GOOGL", "bitcoin")
EVENT_TERMS = {"view": "TSLA", "click": "AMZN", "error": "MSFT", "purchase": "AAPL", "signup": "GOOG"}
PRICE_SYMBOLS = {
    "1-URGENT": "TSLA.US", "2-HIGH": "MSFT.US", "3-MEDIUM": "AMZN.US",
    "4-NOT SPECIFIED": "AAPL.US", "5-LOW": "BTC-USD.CC",
}
SYMBOL_TICKERS = {row[0]: row[1] for row in INSTRUMENTS if row[0]}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pick(column: Column, choices: dict) -> Column:
    """The choice that ``column`` names, else null."""
    (key, value), *rest = choices.items()
    return reduce(lambda out, kv: out.when(column == kv[0], F.lit(kv[1])), rest, F.when(column == key, F.lit(value)))


def posts(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    doc = F.col("doc_id")
    term = F.substring("source", 4, 9).cast("int") % 6
    return d.select(
        doc.cast("string").alias("t_key"),
        F.concat("text", F.lit(" #"), "lang", F.lit(" #"), "source", F.lit(" https://x.example/"),
                 doc.cast("string")).alias("text"),
        (788918400 + (doc % 2400) * 86400 + (doc * 7919) % 86400).alias("created"),
        pick(term, dict(enumerate(POST_TERMS))).alias("search_term"),
        (F.col("n_chars") % 50).cast("int").alias("like_count"),
        (doc % 7).cast("int").alias("retweet_count"),
        (F.col("n_chars") % 1000).cast("int").alias("followers_count"),
        F.concat(F.lit("u"), (doc % 150).cast("string")).alias("writer"),
        doc.alias("tweet_id"),
    )


def dump(spark: SparkSession, sf: str) -> DataFrame:
    """The posts in the layout of the raw dump."""
    return posts(spark, sf).select(
        "tweet_id", "writer", F.col("created").alias("post_date"), F.col("text").alias("body"),
        F.lit(0).alias("comment_num"), F.col("retweet_count").alias("retweet_num"),
        F.col("like_count").alias("like_num"))


def event_seconds(column: str = "ts") -> Column:
    """Whole epoch seconds of a zone-less timestamp, whatever the session time zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            F.col(column).cast("timestamp_ntz"))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    user = F.col("user_id")
    polarity = F.when(user % 37 == 1, F.lit(None)).when(user % 10 == 0, F.lit(0.0)).otherwise(
        F.round(F.col("value") - 25, 2))
    return e.select(
        F.col("event_id").cast("string").alias("t_key"), event_seconds().alias("created"),
        pick(F.col("event_type"), EVENT_TERMS).alias("search_term"), F.lit(0).cast("bigint").alias("id"),
        F.concat("event_type", F.lit(" "), "props").alias("processed_text"), polarity.alias("polarity"),
    )


def prices(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    price = F.col("o_totalprice")
    return o.groupBy(
        pick(F.col("o_orderpriority"), PRICE_SYMBOLS).alias("symbol"),
        F.col("o_orderdate").cast("date").alias("dt"),
    ).agg(
        F.min_by(price, "o_orderkey").alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
        F.max_by(price, "o_orderkey").alias("close"), F.count(F.lit(1)).alias("volume"),
    )


def company_values(spark: SparkSession, sf: str) -> DataFrame:
    p = prices(spark, sf)
    return p.select(
        pick(F.col("symbol"), SYMBOL_TICKERS).alias("ticker_symbol"), F.col("dt").alias("day_date"),
        F.col("open").alias("open_value"), F.col("high").alias("high_value"), F.col("low").alias("low_value"),
        F.col("close").alias("close_value"), "volume",
    )


def tickers(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    raw = {**EVENT_TERMS, "signup": "GOOGL"}
    return e.select(F.col("user_id").alias("tweet_id"),
                    pick(F.col("event_type"), raw).alias("ticker_symbol"), F.col("event_id").alias("line"))


def companies(spark: SparkSession) -> DataFrame:
    """(ticker_symbol, company_name)"""
    rows = instruments(spark).where(F.col("company").isNotNull())
    return rows.select(F.col("ticker").alias("ticker_symbol"), F.col("company").alias("company_name"))


def targets(spark: SparkSession, rows: tuple) -> DataFrame:
    return inline_table(spark, ("search_term", "target"), rows)
