"""Scalar functions by name, for SQL text: cleaning, polarity, and the dashboards' date parser.

They are SQL functions, which the optimizer replaces by their bodies, so nothing leaves the JVM.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from .lexicon import Lexicon
from .text import REMOVAL_PATTERNS

CLEAN_NAME, POLARITY_NAME, DATE_NAME = "cleanTextUdf", "computePolarity", "STR_TO_DATE"

# The dashboards' date specifiers and what they are here.
DATE_SPECIFIERS = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%i": "mm", "%s": "ss"}


def _raw(pattern: str) -> str:
    return "r'" + pattern + "'"


def _clean_body(column: str) -> str:
    body = f"regexp_replace(lower({column}), {_raw(REMOVAL_PATTERNS['urls'])}, ' ')"
    body = f"regexp_replace({body}, {_raw('[^a-z0-9]+')}, ' ')"
    short = r"\b(?:[0-9]+|[a-z0-9]{1,2})\b"
    return f"regexp_replace(regexp_replace({body}, {_raw(short)}, ' '), {_raw(REMOVAL_PATTERNS['whiteSpace'])}, ' ')"


def _polarity_body(lexicon: Lexicon) -> str:
    """The same arithmetic as sentiment.score_clean and sentiment.weighted_polarity, as SQL text."""
    table = json.dumps(lexicon.slots()).replace("\\", "\\\\").replace("'", "\\'")
    slots = f"from_json('{table}', '{lexicon.SLOT_TYPE}')"
    find = f"try_element_at(get({slots}, cast(pmod(crc32(cast(w as binary)), {lexicon.size()}) as int)), w)"
    return f"""
      transform(array(filter(split(coalesce(input, ''), ' '), w -> w <> '')), ws ->
        transform(array(struct(transform(ws, w -> {find}) as codes, array_position(ws, 'but') as but_at)), s ->
          transform(array(aggregate(transform(s.codes, (c, i) ->
            case when c.v is null then 0D else
              aggregate(
                array(struct(get(s.codes, i - 1) as w, 1D as f), struct(get(s.codes, i - 2) as w, 0.95D as f),
                      struct(get(s.codes, i - 3) as w, 0.9D as f)),
                c.v,
                (a, p) -> case when p.w.v is not null then a else
                  (a + coalesce(p.w.b, 0D) * if(a < 0, -1D, 1D) * p.f) * if(p.w.n, -0.74D, 1D) end)
              * case when s.but_at = 0 or i + 1 = s.but_at then 1D when i + 1 < s.but_at then 0.5D else 1.5D end
            end), 0D, (a, b) -> a + b)),
          t -> round(t / sqrt(t * t + 15D), 4) + 0D)[0])[0])[0]
      * (coalesce(followersCount, 0) + 1D) * (coalesce(likeCount, 0) + 1D) * (coalesce(retweetCount, 0) + 1D)"""


def _date_body() -> str:
    # letters between the specifiers stand for themselves
    pattern = "regexp_replace(format, r'(?<!%)([A-Za-z]+)', r\"'$1'\")"
    for theirs, ours in DATE_SPECIFIERS.items():
        pattern = f"replace({pattern}, '{theirs}', '{ours}')"
    return f"try_to_timestamp(input, {pattern})"


def register_functions(spark: SparkSession, lexicon: Lexicon) -> None:
    """Make ``cleanTextUdf(text)``, ``computePolarity(text, likes, retweets, followers)`` and
    ``STR_TO_DATE(text, format)`` callable."""
    spark.sql(f"create or replace temporary function {DATE_NAME}(input string, format string) "
              f"returns timestamp return {_date_body()}")
    spark.sql(f"create or replace temporary function {CLEAN_NAME}(input string) returns string "
              f"return {_clean_body('input')}")
    spark.sql(f"create or replace temporary function {POLARITY_NAME}(input string, likeCount int, "
              f"retweetCount int, followersCount int) returns double return {_polarity_body(lexicon)}")
