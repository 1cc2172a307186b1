"""From posts to the daily polarity per term."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.lexicon import Lexicon
from ..operators.posts import quarantined, score_posts, usable
from ..operators.rollup import daily_polarity, distinct_rows


def score_and_roll_up(posts: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Clean, score and weight every post, then roll up by day and term.

    Scoring is row-local and text is dropped before the only shuffles: the distinct (ids and
    digests) and the rollup (one row per task, day and term).
    """
    return roll_up_and_quarantined(posts, lexicon)[0]


def roll_up_and_quarantined(posts: DataFrame, lexicon: Lexicon) -> tuple[DataFrame, DataFrame]:
    """The rollup, and the posts without text that are not in it."""
    scored, aside = scored_and_quarantined(posts, lexicon)
    return daily_polarity(distinct_rows(scored)), aside


def scored_and_quarantined(posts: DataFrame, lexicon: Lexicon) -> tuple[DataFrame, DataFrame]:
    """Scored posts, and those that cannot be scored; each post is in one of them."""
    return score_posts(usable(posts), lexicon), quarantined(posts)


def roll_up_at_rest(scored: DataFrame) -> DataFrame:
    """Rollup of scored posts read from files, re-delivered rows counted once."""
    return daily_polarity(distinct_rows(scored))
