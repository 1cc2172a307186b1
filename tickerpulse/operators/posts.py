"""Wire records, scored posts and the projections between them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sentiment, text
from ..functions.lexicon import Lexicon
from ..schemas import POST_MESSAGE, SEARCH_PAGE


def encode_posts(posts: DataFrame) -> DataFrame:
    """Posts to (key, value): the post id and the JSON message."""
    message = F.struct(
        F.col("t_key").alias("key"), "text", F.col("created").cast("string").alias("created"),
        F.col("search_term").alias("searchTerm"), F.col("like_count").alias("likeCount"),
        F.col("retweet_count").alias("retweetCount"),
        F.col("followers_count").alias("userFollowersCount"),
    )
    return posts.select(F.col("t_key").alias("key"), F.to_json(message).alias("value"))


def decode_posts(records: DataFrame) -> DataFrame:
    """(key, value) records to flat posts. A value that is no message gives nulls."""
    parsed = records.select(
        F.col("key").cast("string").alias("t_key"),
        F.from_json(F.col("value").cast("string"), POST_MESSAGE).alias("data"))
    return parsed.select(
        "t_key", "data.text", "data.created", F.col("data.searchTerm").alias("search_term"),
        F.col("data.likeCount").alias("like_count"), F.col("data.retweetCount").alias("retweet_count"),
        F.col("data.userFollowersCount").alias("followers_count"))


def usable(posts: DataFrame) -> DataFrame:
    """Posts that can be scored."""
    return posts.where(F.col("text").isNotNull())


def quarantined(posts: DataFrame) -> DataFrame:
    """Malformed messages and posts without text, kept for inspection."""
    return posts.where(F.col("text").isNull())


def flatten_search_page(pages: DataFrame, body: str = "body", term: str = "search_term") -> DataFrame:
    """Search result pages (JSON text, with the term searched for) to one post per row."""
    hit = F.explode(F.from_json(F.col(body), SEARCH_PAGE)["results"]).alias("r")
    return pages.select(F.col(term).alias("search_term"), hit).select(
        F.col("r.id_str").alias("t_key"), F.col("r.text").alias("text"),
        F.col("r.created_at").alias("created"), "search_term",
        F.col("r.favorite_count").alias("like_count"), F.col("r.retweet_count").alias("retweet_count"),
        F.col("r.user.followers_count").alias("followers_count"))


def score_posts(posts: DataFrame, lexicon: Lexicon, weighted: bool = True) -> DataFrame:
    """Posts to scored posts, in the column order of the files at rest."""
    compound = sentiment.score_words(F.col("_clean.words"), lexicon)
    polarity = compound if not weighted else sentiment.weighted_polarity(
        compound, F.col("like_count"), F.col("retweet_count"), F.col("followers_count"))
    return posts.withColumn("_clean", text.clean_parts(F.col("text"))).select(
        "t_key", "created", "search_term", F.lit(0).cast("bigint").alias("id"),
        F.col("_clean.text").alias("processed_text"), polarity.alias("polarity"))


def dated_polarity(scored: DataFrame, day: Callable[[Column], Column]) -> DataFrame:
    """The four columns the rollup needs."""
    return scored.select("t_key", day(F.col("created")).alias("date"), "search_term", "polarity")


def with_compound(posts: DataFrame, lexicon: Lexicon, raw: bool = True) -> DataFrame:
    """Add ``compound``, its label and the three 1.0/0.0 label columns."""
    score = sentiment.score_raw(F.col("text"), lexicon) if raw else sentiment.score_words(
        text.clean_words(F.col("text")), lexicon)
    labelled = posts.withColumn("compound", score).withColumn("sentiment", sentiment.label(F.col("compound")))
    flags = {name: (F.col("sentiment") == name).cast("double") for name in ("positive", "negative", "neutral")}
    return labelled.withColumns(flags)


def trending_hashtags(posts: DataFrame, top: int = 10) -> DataFrame:
    """The most used hashtags with their mentions; ties in alphabetical order."""
    tags = posts.select(F.explode(text.hashtags(F.col("text"))).alias("label"))
    counts = tags.groupBy("label").agg(F.count(F.lit(1)).alias("mentions"))
    return counts.orderBy(F.desc("mentions"), "label").limit(top)


def word_counts(lines: DataFrame, column: str = "text") -> DataFrame:
    """Count of each blank-separated word; on a stream, the running count. Blanks at either end, or
    several in a row, make no empty words."""
    words = lines.select(F.explode(F.split(F.col(column), " ")).alias("word")).where("word <> ''")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
