"""Calendar and epoch expressions. Text formats follow Spark's datetime patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
COMPACT_MINUTE = "yyyyMMddHHmm"


def epoch_seconds_text(seconds: Column, fmt: str = SECOND_FORMAT) -> Column:
    return F.date_format(F.timestamp_seconds(seconds.cast("bigint")), fmt)


def epoch_hour(seconds: Column) -> Column:
    """Hour of day of epoch seconds, in the session time zone."""
    return F.hour(F.timestamp_seconds(seconds.cast("bigint")))


def epoch_millis_text(millis: Column, fmt: str = SECOND_FORMAT) -> Column:
    return F.date_format(F.timestamp_millis(millis.cast("bigint")), fmt)


def any_time_text(value: Column, fmt: str = SECOND_FORMAT) -> Column:
    """Epoch milliseconds, digits as text, or ISO-8601 text, all to one format."""
    text = value.cast("string")
    instant = F.coalesce(F.timestamp_millis(text.try_cast("bigint")), F.try_to_timestamp(text))
    return F.date_format(instant, fmt)


def compact_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to ``yyyyMMddHHmmss``; NULL when blank or date only."""
    words = F.split(F.rtrim(text), " ")
    joined = F.concat(
        F.replace(words[0], F.lit("-"), F.lit("")), F.replace(F.get(words, F.lit(1)), F.lit(":"), F.lit(""))
    )
    return F.when((F.trim(text) != "") & (F.size(words) > 1), joined)


def compact_date(text: Column) -> Column:
    """``yyyy-MM-dd`` to ``yyyyMMdd``; NULL when blank."""
    return F.when(F.trim(text) != "", F.replace(text, F.lit("-"), F.lit("")))


def days_before(text: Column, days: int = 15, fmt: str = COMPACT_MINUTE) -> Column:
    """Shift text of a given format back by whole days."""
    instant = F.try_to_timestamp(text, F.lit(fmt))
    return F.date_format(instant - F.expr(f"INTERVAL {int(days)} DAYS"), fmt)


def month_suffix(ts: Column) -> Column:
    """Table suffix ``yyyyMM``, for every month of the year."""
    return F.date_format(ts, "yyyyMM")
