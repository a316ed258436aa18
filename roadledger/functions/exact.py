"""Rounding that does not depend on binary fractions or on summation order."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact(value: Column, scale: int = 10) -> Column:
    """A double as DECIMAL; absorbs the last-bit noise of a distributed sum. NULL beyond its range."""
    return value.try_cast(f"decimal(28,{scale})")


def rounded(value: Column, digits: int) -> Column:
    """Half-up rounding on the decimal value, as NUMERIC rounding does."""
    return F.round(exact(value), digits).cast(f"decimal(18,{digits})")


def as_percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` rounded half-up to two digits in integer arithmetic."""
    hundredths = F.call_function("div", part * 20000 + whole, F.nullif(whole * 2, F.lit(0)))
    return (hundredths * F.lit(Decimal("0.01"))).cast("decimal(5,2)")
