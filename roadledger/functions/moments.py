"""Event-time decoding and calendar labels."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: numbers of at least this size are milliseconds, smaller ones seconds.
MILLIS_FROM = 1e11


def instant(value: str | date | datetime | Column) -> Column:
    """A point in time, read in the session time zone, as a literal column."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    return F.lit(str(value)).cast("timestamp")


def event_ts(raw: Column) -> Column:
    """Decode the four encodings of event time found in telemetry files.

    Text holding a number (scientific notation included) is an epoch in seconds or
    milliseconds by magnitude; anything else is tried as ISO-8601. Undecodable text
    becomes NULL.
    """
    number = raw.cast("string").try_cast("double")
    micros = F.when(F.abs(number) >= MILLIS_FROM, number * 1e3).otherwise(number * 1e6)
    return F.coalesce(
        F.timestamp_micros(F.round(micros).try_cast("bigint")),
        F.when(number.isNull(), raw.cast("string").try_cast("timestamp")),
    )


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def sunday_zero_weekday(ts: Column) -> Column:
    """Day of week with Sunday = 0 (Spark counts Sunday as 1)."""
    return F.dayofweek(ts) - 1


def time_category(ts: Column, wrapped: bool = False) -> Column:
    """Rush-hour label of a crash.

    With ``wrapped=False`` the night rule is the literal ``BETWEEN 22 AND 5``, which
    no hour satisfies, so nights are DAYTIME. ``wrapped=True`` wraps past midnight.
    """
    hour = F.hour(ts)
    night = (hour >= 22) | (hour <= 5) if wrapped else hour.between(22, 5)
    return (
        F.when(hour.between(6, 9), "MORNING_RUSH")
        .when(hour.between(17, 19), "EVENING_RUSH")
        .when(night, "NIGHT")
        .otherwise("DAYTIME")
    )


def minutes_since(ts: Column, as_of) -> Column:
    return (F.unix_micros(instant(as_of)) - F.unix_micros(ts)) / F.lit(6e7)
