"""The fifteen standard reports on telemetry, crashes and policies."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import activity, crashes, enrich, risk, timespan


def standard_reports(
    tel: DataFrame, crash: DataFrame, core: dict[str, DataFrame], as_of: str
) -> dict[str, Callable[[], DataFrame]]:
    """Reports by name, each built when called. ``as_of`` is the time of the report."""
    customers, policies, vehicles = core["customers"], core["policies"], core["vehicles"]
    day = date.fromisoformat(str(as_of)[:10])
    by_count = (F.col("crash_count").desc(), activity.sort_key("avg_risk_score").desc_nulls_first())

    def behavior() -> DataFrame:
        week = timespan.trailing(tel, "date", as_of, days=7)
        return activity.top(
            activity.vehicle_behavior_summary(week), 10, F.col("max_g_force").desc_nulls_first(),
            F.col("date").desc(), F.col("policy_id").asc_nulls_last(), F.col("vin").asc_nulls_last())

    def hard_events() -> DataFrame:
        last_day = timespan.recent_events(tel, as_of, hours=24)
        return activity.top(
            activity.high_gforce_events(last_day).select(
                "policy_id", "vin", "event_ts", "current_street", "g_force", "speed_mph", "severity_level"),
            20, F.col("g_force").desc(), F.col("event_ts").desc(), F.col("vin").asc_nulls_last())

    def emergencies() -> DataFrame:
        queue = enrich.emergency_queue(
            enrich.crash_enriched(crash, vehicles, policies, customers), as_of)
        return activity.top(queue, 10, F.col("response_priority").asc(),
                            F.col("crash_timestamp").desc(), F.col("report_id").asc())

    return {
        "telemetry_rows": lambda: activity.row_counts(total_telemetry_records=tel),
        "data_freshness": lambda: activity.data_freshness(tel),
        "crash_rows": lambda: activity.row_counts(total_crash_reports=crash),
        "vehicle_behavior": behavior,
        "high_gforce_events": hard_events,
        "speeding": lambda: activity.speeding_analysis(tel, as_of),
        "device_health": lambda: activity.device_health(tel, as_of),
        "recent_crashes": lambda: crashes.recent_crashes(crash, as_of).orderBy(
            F.col("crash_count").desc(), F.col("crash_type").asc_nulls_last(),
            F.col("severity_level").asc_nulls_last()),
        "emergency_queue": emergencies,
        "crash_patterns": lambda: activity.top(
            crashes.crash_patterns(crash), 10, *by_count, F.col("crash_type").asc_nulls_last()),
        "crash_hotspots": lambda: activity.top(
            crashes.crash_hotspots(crash), 10, *by_count,
            F.col("lat_zone").asc_nulls_last(), F.col("lng_zone").asc_nulls_last()),
        "customer_risk": lambda: risk.customer_risk_profile(customers, policies, tel, crash, as_of),
        "vehicle_safety": lambda: risk.vehicle_safety(vehicles, tel, crash, as_of),
        "data_completeness": lambda: activity.data_completeness(tel, crash, as_of),
        "performance_probe": lambda: activity.performance_probe(tel, day),
    }
