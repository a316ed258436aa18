"""Reports on crash patterns and places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo_zone, sunday_zero_weekday
from .timespan import trailing


def crash_patterns(crash: DataFrame) -> DataFrame:
    """Per crash type: counts, averages, weekend share, centroid and time range."""
    ts = F.col("crash_timestamp")
    return crash.groupBy("crash_type").agg(
        F.count(F.lit(1)).alias("crash_count"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.avg("total_g_force").alias("avg_g_force"),
        F.avg("speed_at_impact").alias("avg_impact_speed"),
        F.count_if("emergency_recommended").alias("emergency_cases"),
        F.count_if("rollover_detected").alias("rollover_cases"),
        F.count_if("spinning_detected").alias("spinning_cases"),
        F.avg(F.hour(ts)).alias("avg_crash_hour"),
        F.count_if(sunday_zero_weekday(ts).isin(0, 6)).alias("weekend_crashes"),
        F.avg("crash_latitude").alias("avg_latitude"),
        F.avg("crash_longitude").alias("avg_longitude"),
        F.max("crash_timestamp").alias("latest_crash"),
        F.min("crash_timestamp").alias("earliest_crash"),
    )


def crash_hotspots(crash: DataFrame, min_count: int = 2) -> DataFrame:
    """Grid cells with at least ``min_count`` crashes and their street names.

    Rows are reduced to one per cell and street before the cell's list is built, so a cell
    holding a large share of all crashes sends only its distinct streets to one task.
    """
    per_street = crash.groupBy(
        geo_zone(F.col("crash_latitude")).alias("lat_zone"),
        geo_zone(F.col("crash_longitude")).alias("lng_zone"),
        "current_street",
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("risk_score").alias("risk_sum"),
        F.count("risk_score").alias("risk_n"),
        F.count_if("emergency_recommended").alias("emergencies"),
        F.max("crash_timestamp").alias("latest"),
    )
    return (
        per_street.groupBy("lat_zone", "lng_zone")
        .agg(
            F.sum("n").alias("crash_count"),
            F.try_divide(F.sum("risk_sum"), F.sum("risk_n")).alias("avg_risk_score"),
            F.sum("emergencies").alias("emergency_crashes"),
            F.expr("listagg(current_street, ', ') within group (order by current_street)").alias("streets"),
            F.max("latest").alias("latest_crash"),
        )
        .where(F.col("crash_count") >= min_count)
    )


def recent_crashes(crash: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Crashes of the last ``days`` by type and severity."""
    return trailing(crash, "report_date", as_of, days=days).groupBy("crash_type", "severity_level").agg(
        F.count(F.lit(1)).alias("crash_count"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.count_if("emergency_recommended").alias("emergency_cases"),
    )
