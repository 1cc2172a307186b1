"""Record layouts shared by the batch and streaming code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def struct_of(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# Message value on the wire.
POST_MESSAGE = struct_of(
    ("key", _S), ("text", _S), ("created", _S), ("searchTerm", _S),
    ("likeCount", _I), ("retweetCount", _I), ("userFollowersCount", _I),
)

# Scored posts at rest; the column order is the order in the CSV files.
SCORED_POST = struct_of(
    ("t_key", _S), ("created", _S), ("search_term", _S),
    ("id", _L), ("processed_text", _S), ("polarity", _D),
)

POST_DUMP = struct_of(
    ("tweet_id", _L), ("writer", _S), ("post_date", _L), ("body", _S),
    ("comment_num", _I), ("retweet_num", _I), ("like_num", _I),
)

POST_TICKER = struct_of(("tweet_id", _L), ("ticker_symbol", _S))

COMPANY = struct_of(("ticker_symbol", _S), ("company_name", _S))

COMPANY_VALUES = struct_of(
    ("ticker_symbol", _S), ("day_date", T.DateType()), ("open_value", _D), ("high_value", _D),
    ("low_value", _D), ("close_value", _D), ("volume", _L),
)

DAILY_BARS = struct_of(
    ("Date", T.DateType()), ("Open", _D), ("High", _D), ("Low", _D),
    ("Close", _D), ("Adjusted_close", _D), ("Volume", _L),
)

DAILY_POLARITY = struct_of(
    ("date", T.DateType()), ("search_term", _S), ("count", _L), ("agg_polarity", _D),
    ("positive_count", _L), ("negative_count", _L), ("neutral_count", _L),
)

SEARCH_PAGE = T.StructType([
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("id_str", _S),
        T.StructField("text", _S),
        T.StructField("created_at", _S),
        T.StructField("favorite_count", _I),
        T.StructField("retweet_count", _I),
        T.StructField("user", T.StructType([T.StructField("followers_count", _I)])),
    ]))),
    T.StructField("next", _S),
])

# Instruments known to the collection, as (symbol, ticker, term, company).
INSTRUMENTS = (
    ("TSLA.US", "TSLA", "tesla", "Tesla Inc"),
    ("MSFT.US", "MSFT", "microsoft", "Microsoft"),
    ("AMZN.US", "AMZN", "amazon", "Amazon.com"),
    ("AAPL.US", "AAPL", "apple", "apple"),
    ("BTC-USD.CC", "BTC", "bitcoin", None),
    (None, "GOOG", None, "Google Inc"),
)

# Gauge targets per ticker, and for the whole collection.
TERM_TARGETS = (
    ("TSLA", 799_999), ("AMZN", 900_000), ("MSFT", 799_997),
    ("AAPL", 279_997), ("GOOG", 180_000_000),
)
TOTAL_TARGET = 4_000_000


def _literal(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def inline_table(spark: SparkSession, columns: tuple[str, ...], rows: tuple) -> DataFrame:
    """A literal table. Its size is known to the optimizer, which then picks the join by it."""
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"select * from values {values} as t({', '.join(columns)})")


def instruments(spark: SparkSession) -> DataFrame:
    return inline_table(spark, ("symbol", "ticker", "term", "company"), INSTRUMENTS)
