"""Forces and severity derived from the inertial sensors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Standard gravity used by the score, and severity bands (g, inclusive).
GRAVITY = 9.81
SEVERITY_BANDS = ((8.0, "CRITICAL"), (6.0, "SEVERE"), (4.0, "HIGH"), (2.0, "MODERATE"))


def _length(*axes: str) -> Column:
    total = F.col(axes[0]) * F.col(axes[0])
    for axis in axes[1:]:
        total = total + F.col(axis) * F.col(axis)
    return F.sqrt(total)


def g_of(*axes: str) -> Column:
    """Length of an acceleration vector in g."""
    return _length(*axes) / GRAVITY


def with_forces(df: DataFrame) -> DataFrame:
    """Add calculated, lateral and vertical g-force and the gyroscope magnitude."""
    return df.withColumns({
        "calculated_g_force": g_of("accelerometer_x", "accelerometer_y", "accelerometer_z"),
        "lateral_g_force": g_of("accelerometer_x", "accelerometer_y"),
        "vertical_g_force": F.abs((F.col("accelerometer_z") - GRAVITY) / GRAVITY),
        "gyro_magnitude": _length("gyroscope_x", "gyroscope_y", "gyroscope_z"),
    })


def severity_level(g_force: Column) -> Column:
    """Severity band of a g-force; NULL counts as NORMAL."""
    (edge, label), *rest = SEVERITY_BANDS
    level = F.when(g_force >= edge, label)
    for edge, label in rest:
        level = level.when(g_force >= edge, label)
    return level.otherwise("NORMAL")
