"""Temporary views under the table and view names that SQL users query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import activity, crashes, enrich, scoring


def _orders() -> dict[str, list[Column]]:
    """Order in which each view lists its rows.

    Views are sorted because their users add only a LIMIT; the operators never sort.
    """
    return {
        "v_high_gforce_events": [F.col("g_force").desc(), F.col("event_time").desc_nulls_first()],
        "v_vehicle_behavior_summary": [F.col("date").desc_nulls_first(), F.col("policy_id").asc_nulls_last()],
        "v_emergency_response_queue": [F.col("response_priority").asc(), F.col("crash_timestamp").desc()],
        "v_crash_patterns": [F.col("crash_count").desc(), F.col("avg_risk_score").desc_nulls_first()],
        "v_crash_hotspots": [F.col("crash_count").desc(), F.col("avg_risk_score").desc_nulls_first()],
    }


def views(tel: DataFrame, crash: DataFrame, core: dict[str, DataFrame], as_of,
          scores: DataFrame | None = None) -> dict[str, DataFrame]:
    """All source tables and analytical views by name.

    ``event_time`` holds the decoded time here, so queries may compare it with dates.
    """
    tel = tel.withColumn("event_time", F.col("event_ts"))
    owners = (core["vehicles"], core["policies"], core["customers"])
    enriched_crashes = enrich.crash_enriched(crash, *owners)
    out = {
        "vehicle_telemetry_data_v2": tel,
        "vehicle_telemetry_data": tel,
        "crash_reports_data": crash,
        **core,
        "v_vehicle_telemetry_enriched": enrich.telemetry_enriched(tel, *owners),
        "v_high_gforce_events": activity.high_gforce_events(tel).withColumnRenamed("event_ts", "event_time"),
        # By folder, so that a date in a query prunes folders.
        "v_vehicle_behavior_summary": activity.vehicle_behavior_summary(tel, by_folder=True),
        "v_crash_reports_enriched": enriched_crashes,
        "v_emergency_response_queue": enrich.emergency_queue(enriched_crashes, as_of),
        "v_crash_patterns": crashes.crash_patterns(crash),
        "v_crash_hotspots": crashes.crash_hotspots(crash),
    }
    if scores is not None:
        out["safe_driver_scores"] = scores
        out["v_current_driver_scores"] = scoring.current_scores(scores)
    return out


def register_views(tel: DataFrame, crash: DataFrame, core: dict[str, DataFrame], as_of,
                   scores: DataFrame | None = None) -> list[str]:
    """Create the views in the session and return their names."""
    orders = _orders()
    named = views(tel, crash, core, as_of, scores)
    for name, df in named.items():
        (df.orderBy(*orders[name]) if name in orders else df).createOrReplaceTempView(name)
    return list(named)
