"""Reports on telemetry: events, vehicles, devices, freshness and completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import day_of, g_of, severity_level
from .timespan import trailing

# Each report keeps its own limits; they are not meant to agree.
HIGH_G_EVENT = 2.0
SPEEDING_MPH = 80
SEVERE_SPEEDING_MPH = 90
POOR_SIGNAL_DBM = -80


def top(df: DataFrame, k: int | None, *order: Column) -> DataFrame:
    """The first ``k`` rows in ``order`` (all rows, unsorted, for ``None``)."""
    return df if k is None else df.orderBy(*order).limit(k)


def sort_key(average: str) -> Column:
    """An average as a sort key, rounded so that summation order cannot decide a tie."""
    return F.round(F.col(average), 6)


def high_gforce_events(tel: DataFrame, min_g: float = HIGH_G_EVENT) -> DataFrame:
    """Telemetry rows of at least ``min_g`` with computed force and severity."""
    return tel.where(F.col("g_force") >= min_g).select(
        "policy_id", "vin", "event_ts", "current_street", "speed_mph", "speed_limit_mph", "g_force",
        "gps_latitude", "gps_longitude", "accelerometer_x", "accelerometer_y", "accelerometer_z",
        g_of("accelerometer_x", "accelerometer_y", "accelerometer_z").alias("calculated_g_force"),
        severity_level(F.col("g_force")).alias("severity_level"),
    )


def vehicle_behavior_summary(tel: DataFrame, by_folder: bool = False) -> DataFrame:
    """Per policy, vehicle and day: counts, speeds, forces, violations, device averages.

    The day is the event's, or with ``by_folder`` that of the date folder the row is stored in:
    a filter on it then leaves other folders unread.
    """
    day = F.col("date") if by_folder else day_of(F.col("event_ts"))
    return tel.groupBy("policy_id", "vin", day.alias("date")).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.avg("speed_mph").alias("avg_speed"),
        F.max("speed_mph").alias("max_speed"),
        F.avg("g_force").alias("avg_g_force"),
        F.max("g_force").alias("max_g_force"),
        F.count_if(F.col("g_force") > 2.0).alias("high_gforce_events"),
        F.count_if(F.col("speed_mph") > SPEEDING_MPH).alias("speeding_events"),
        F.count_if(F.col("speed_mph") > F.col("speed_limit_mph")).alias("speed_limit_violations"),
        F.avg("device_battery_level").alias("avg_battery_level"),
        F.avg("gps_accuracy").alias("avg_gps_accuracy"),
    )


def speeding_analysis(tel: DataFrame, as_of, days: int = 7, k: int | None = 15) -> DataFrame:
    """Vehicles seen above 80 mph in the last ``days``, worst first."""
    report = (
        trailing(tel, "date", as_of, days=days)
        .groupBy("policy_id", "vin")
        .agg(
            F.avg("speed_mph").alias("avg_speed"),
            F.max("speed_mph").alias("max_speed"),
            F.count_if(F.col("speed_mph") > SPEEDING_MPH).alias("speeding_violations"),
            F.count_if(F.col("speed_mph") > SEVERE_SPEEDING_MPH).alias("severe_speeding"),
            F.count(F.lit(1)).alias("total_records"),
        )
        .where(F.col("speeding_violations") > 0)
    )
    return top(
        report, k, F.col("speeding_violations").desc(), F.col("max_speed").desc_nulls_first(),
        F.col("policy_id").asc_nulls_last(), F.col("vin").asc_nulls_last(),
    )


def device_health(tel: DataFrame, as_of, days: int = 3, low_battery: float = 20,
                  k: int | None = 10) -> DataFrame:
    """Battery and signal per vehicle over the last ``days``, most low-battery events first."""
    report = (
        trailing(tel, "date", as_of, days=days)
        .groupBy("policy_id", "vin")
        .agg(
            F.avg("device_battery_level").alias("avg_battery"),
            F.min("device_battery_level").alias("min_battery"),
            F.avg("device_signal_strength").alias("avg_signal"),
            F.count_if(F.col("device_battery_level") < low_battery).alias("low_battery_events"),
            F.count_if(F.col("device_signal_strength") < POOR_SIGNAL_DBM).alias("poor_signal_events"),
            F.max("event_ts").alias("last_seen"),
        )
    )
    return top(
        report, k, F.col("low_battery_events").desc(), F.col("poor_signal_events").desc(),
        F.col("policy_id").asc_nulls_last(), F.col("vin").asc_nulls_last(),
    )


def policy_bitmaps(tel: DataFrame) -> DataFrame:
    """Per date and block of policy numbers: which policies reported, as a bitmap, and the first
    and last event.

    Bitmaps of different dates, or of pieces of one date, unite to those of all: kept as a table,
    only new dates need their telemetry read. Rows are first reduced to one per date and policy
    by an aggregate that works on them as they come.
    """
    seen = tel.groupBy("date", "policy_id").agg(F.min("event_ts").alias("earliest"), F.max("event_ts").alias("latest"))
    number = F.col("policy_id").cast("bigint")
    return seen.groupBy("date", F.bitmap_bucket_number(number).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("policies"),
        F.min("earliest").alias("earliest"), F.max("latest").alias("latest"))


def freshness_of(bitmaps: DataFrame) -> DataFrame:
    """The freshness report from :func:`policy_bitmaps` of any pieces of the telemetry."""
    blocks = bitmaps.groupBy("block").agg(
        F.bitmap_or_agg("policies").alias("policies"), F.sort_array(F.collect_set("date")).alias("dates"),
        F.min("earliest").alias("earliest"), F.max("latest").alias("latest"))
    return blocks.agg(
        F.min("earliest").alias("earliest_record"),
        F.max("latest").alias("latest_record"),
        F.size(F.array_distinct(F.flatten(F.collect_set("dates")))).cast("bigint").alias("unique_dates"),
        F.coalesce(F.sum(F.bitmap_count("policies")), F.lit(0)).alias("unique_policies"),
    )


def data_freshness(tel: DataFrame, approximate: bool = False) -> DataFrame:
    """First and last event and the number of distinct dates and policies.

    Counted exactly by bitmaps that merge (:func:`policy_bitmaps`); ``approximate`` takes sketches.
    """
    if not approximate:
        return freshness_of(policy_bitmaps(tel))
    return tel.agg(
        F.min("event_ts").alias("earliest_record"),
        F.max("event_ts").alias("latest_record"),
        F.approx_count_distinct("date").alias("unique_dates"),
        F.approx_count_distinct("policy_id").alias("unique_policies"),
    )


def row_counts(**tables: DataFrame) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("total_records"))
        .select(F.lit(name).alias("table_name"), "total_records")
        for name, df in tables.items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionAll(more)
    return out


def performance_probe(tel: DataFrame, day, above_g: float = 1.0) -> DataFrame:
    """One day's events above ``above_g``: the predicate prunes to a single folder."""
    return tel.where((F.col("date") == F.lit(str(day)).cast("date")) & (F.col("g_force") > above_g)).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min("event_ts").alias("time_range_start"),
        F.max("event_ts").alias("time_range_end"),
        F.count_distinct("policy_id").alias("unique_policies"),
        F.avg("g_force").alias("avg_g_force"),
    )


def data_completeness(tel: DataFrame, crash: DataFrame, as_of, telemetry_days: int = 7,
                      crash_days: int = 30) -> DataFrame:
    """Missing values of recent telemetry and crash rows, one row per table.

    The second row reuses the first one's column names: for crashes ``missing_gps`` counts
    missing locations and ``missing_device_data`` missing risk scores.
    """

    def row(name: str, df: DataFrame, place: str, extra: str, day: str) -> DataFrame:
        def missing(column: str) -> Column:
            return F.count_if(F.col(column).isNull())

        # Rows are counted once per day and policy; days and policies are counted from that.
        seen = df.groupBy(F.col(day).alias("_day"), "policy_id").agg(
            F.count(F.lit(1)).alias("total_records"),
            missing("policy_id").alias("missing_policy_id"),
            missing("vin").alias("missing_vin"),
            missing(place).alias("missing_gps"),
            missing(extra).alias("missing_device_data"),
        )
        counts = ("total_records", "missing_policy_id", "missing_vin", "missing_gps", "missing_device_data")
        days = seen.groupBy("_day").agg(*[F.sum(c).alias(c) for c in counts]).select(
            *counts, F.col("_day").isNotNull().cast("bigint").alias("unique_dates"), F.lit(0).alias("unique_policies"))
        policies = seen.where(F.col("policy_id").isNotNull()).select("policy_id").distinct().select(
            *[F.lit(0).alias(c) for c in (*counts, "unique_dates")], F.lit(1).alias("unique_policies"))
        return days.unionAll(policies).agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*counts, "unique_dates", "unique_policies")]
        ).select(F.lit(name).alias("table_name"), "*")

    events = trailing(tel, "date", as_of, days=telemetry_days)
    reports = trailing(crash, "report_date", as_of, days=crash_days)
    return row("vehicle_telemetry_data", events, "gps_latitude", "device_battery_level", "date").unionAll(
        row("crash_reports_data", reports, "crash_latitude", "risk_score", "report_date")
    )
