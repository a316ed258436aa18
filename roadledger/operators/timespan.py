"""Trailing time windows and date-partition prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import instant


def trailing(
    df: DataFrame, column: str, as_of, *, days: int = 0, hours: int = 0, from_midnight: bool = True
) -> DataFrame:
    """Rows whose ``column`` is within the last ``days`` and ``hours`` before ``as_of``.

    Counted from the start of the day of ``as_of``, or from its exact time with
    ``from_midnight=False``. ``column`` may be a date or a timestamp; on the ``date``
    partition column the predicate prunes folders.
    """
    start = F.date_trunc("day", instant(as_of)) if from_midnight else instant(as_of)
    start = start - F.expr(f"INTERVAL '{days * 24 + hours}' HOUR")
    if df.schema[column].dataType.typeName() == "date":
        return df.where(F.col(column) >= F.to_date(start))
    return df.where(F.col(column) >= start)


def recent_events(df: DataFrame, as_of, *, hours: int, from_midnight: bool = True) -> DataFrame:
    """Telemetry of the last ``hours`` by event time, with the date predicate that prunes.

    Catalyst cannot derive the folder from ``event_ts``, so a date range with a day of
    slack for time zones stands beside it.
    """
    start = F.date_trunc("day", instant(as_of)) if from_midnight else instant(as_of)
    start = start - F.expr(f"INTERVAL '{hours}' HOUR")
    return df.where(F.col("date") >= F.date_sub(F.to_date(start), 1)).where(F.col("event_ts") >= start)


def partition_prefix(inventory: DataFrame, prefix: str) -> DataFrame:
    """Date partitions whose text starts with ``YYYY`` or ``YYYY-MM``."""
    return inventory.where(F.col("date").cast("string").startswith(prefix))
