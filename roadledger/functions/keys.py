"""Join and grouping keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def policy_key(policy_id: Column) -> Column:
    """Policy id as a number; text that is not a number becomes NULL and joins nothing."""
    return policy_id.try_cast("bigint")


def geo_zone(coordinate: Column, digits: int = 3) -> Column:
    """A coordinate rounded to a grid cell, in DECIMAL so the edge is exact. What is no
    coordinate at all (beyond the type's range) has no cell: NULL."""
    return F.round(coordinate.try_cast("decimal(20,12)"), digits)
