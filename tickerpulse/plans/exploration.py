"""The labelled posts that the exploratory reports start from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timeparse
from ..functions.lexicon import Lexicon
from ..operators.enrich import attach_company
from ..operators.posts import with_compound


def processed_posts(dump: DataFrame, tickers: DataFrame, companies: DataFrame, lexicon: Lexicon,
                    order: str = "line", keep_text: bool = False) -> DataFrame:
    """Raw posts (tweet_id, writer, post_date, body, ...) with company, score, label and day.

    Posts are scored before the company is joined, so unless it is kept, no text is shuffled.
    """
    scored = with_compound(dump.withColumnRenamed("body", "text"), lexicon)
    scored = scored.withColumnRenamed("text", "body") if keep_text else scored.drop("text")
    day = timeparse.day_of_epoch(F.col("post_date"))
    return attach_company(scored, tickers, companies, order).withColumns({
        "day_date": timeparse.day_string(F.col("post_date")), "year": timeparse.year_of(day),
        "day_passed": timeparse.days_passed(day)})
