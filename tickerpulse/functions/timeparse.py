"""The encodings of ``created`` and the day arithmetic built on them (all in UTC)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_SECONDS = 86_400
FIRST_DAY = "2015-01-01"


def day_of_epoch(seconds: Column) -> Column:
    """UTC date of epoch seconds, by integer arithmetic, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(seconds / F.lit(DAY_SECONDS)).cast("int"))


def day_string(seconds: Column) -> Column:
    """``yyyy-MM-dd`` of epoch seconds."""
    return day_of_epoch(seconds).cast("string")


def parse_iso(text: Column) -> Column:
    """``2021-10-26T21:22:54Z`` to a timestamp; anything else is null."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssX"))


def created_seconds(text: Column) -> Column:
    """Epoch seconds of text that holds epoch seconds, ISO text or
    ``Thu Feb 01 10:00:00 +0000 2018``; else null."""
    provider = F.try_to_timestamp(F.substring(text, 5, 64), F.lit("MMM dd HH:mm:ss Z yyyy"))
    return F.coalesce(text.try_cast("bigint"), F.unix_seconds(parse_iso(text)), F.unix_seconds(provider))


def parse_created(text: Column) -> Column:
    """The same as a timestamp."""
    return F.timestamp_seconds(created_seconds(text))


def seconds_of(df: DataFrame, column: str = "created") -> Column:
    """Epoch seconds of a column that holds them as numbers or in one of the text encodings."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return created_seconds(F.col(column))
    return F.col(column).cast("bigint")


def days_passed(day: Column, start: str = FIRST_DAY) -> Column:
    return F.datediff(day, F.lit(start).cast("date"))


def year_of(day: Column) -> Column:
    return F.year(day)


def bucket_start(seconds: Column, width: int) -> Column:
    """Start, in epoch seconds, of the ``width``-second bucket that holds ``seconds``."""
    return (F.floor(seconds / F.lit(width)) * F.lit(width)).cast("bigint")
