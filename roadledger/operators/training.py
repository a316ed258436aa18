"""Per-driver behaviour features, training data and the new-data gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_percent, instant, rounded

# Limits of the behaviour features.
HARSH_G = 1.5
EXTREME_G = 3.0
PHONE_MIN_MPH = 5
EXCESS_MPH = 10
LOW_BATTERY = 20

# Fixed value: events after this count as new for a driver without a refresh time.
EPOCH_OF_GATE = "2024-01-01 00:00:00"


def _flag(condition: Column) -> Column:
    return F.count_if(condition)


def behaviour_counts() -> list[Column]:
    """The additive part of the features: counts of rows and of each kind of event."""
    return [
        F.count(F.lit(1)).alias("total_events"),
        _flag(F.col("speed_mph") > F.col("speed_limit_mph")).alias("violations"),
        _flag(F.col("g_force") > HARSH_G).alias("harsh_driving_events"),
        _flag(F.col("device_screen_on") & (F.col("speed_mph") > PHONE_MIN_MPH)).alias("phone_events"),
        _flag(F.col("speed_mph") > F.col("speed_limit_mph") + EXCESS_MPH).alias("excessive_speeding_count"),
    ]


def features_of(raw: DataFrame, as_of, *more: Column | str) -> DataFrame:
    """Feature columns from counts, means, maxima and the speed deviation of each driver."""
    total = F.col("total_events")
    return raw.select(
        "driver_id",
        "total_events",
        as_percent(total - F.col("violations"), total).alias("speed_compliance_rate"),
        rounded(F.col("g_mean"), 4).alias("avg_g_force"),
        "harsh_driving_events",
        as_percent(F.col("phone_events"), total).alias("phone_usage_rate"),
        rounded(F.col("speed_deviation"), 2).alias("speed_variance"),
        rounded(F.col("speed_mean"), 2).alias("avg_speed"),
        rounded(F.col("speed_max"), 2).alias("max_speed"),
        "excessive_speeding_count",
        instant(as_of).alias("last_updated"),
        *more,
    )


def driver_features(tel: DataFrame, as_of, extended: bool = False) -> DataFrame:
    """Behaviour of each driver over all telemetry given.

    One aggregation of mergeable functions: every task reduces its rows to one per driver
    before the shuffle, so a driver holding a large share of the rows costs no more than
    the others. ``speed_variance`` is a standard deviation, as its users expect. A NULL
    speed counts as compliant. ``extended`` adds the columns of the older metric set.
    """
    driven = tel.where(F.col("driver_id").isNotNull())
    aggregates = behaviour_counts() + [
        F.avg("g_force").alias("g_mean"),
        F.avg("speed_mph").alias("speed_mean"),
        F.max("speed_mph").alias("speed_max"),
        F.stddev_samp("speed_mph").alias("speed_deviation"),
    ]
    if not extended:
        return features_of(driven.groupBy("driver_id").agg(*aggregates), as_of)

    over = F.col("speed_mph") - F.col("speed_limit_mph")
    squared = F.col("accelerometer_x") * F.col("accelerometer_x")
    for axis in ("accelerometer_y", "accelerometer_z"):
        squared = squared + F.col(axis) * F.col(axis)
    aggregates += [
        F.avg(F.when(over > 0, over).otherwise(0.0)).alias("over_mean"),
        F.max("g_force").alias("g_max"),
        _flag(F.col("g_force") > EXTREME_G).alias("extreme_events"),
        _flag((F.col("device_battery_level") < LOW_BATTERY) & (F.col("speed_mph") > 0))
        .alias("low_battery_driving_events"),
        F.var_samp("speed_mph").alias("speed_var"),
        F.var_samp(squared).alias("acceleration_var"),
    ]
    return features_of(
        driven.groupBy("driver_id").agg(*aggregates), as_of,
        rounded(F.col("over_mean"), 2).alias("avg_speed_violation"),
        rounded(F.col("g_max"), 4).alias("max_g_force"),
        "extreme_events", "low_battery_driving_events",
        rounded(F.col("speed_var"), 4).alias("speed_variance_squared"),
        rounded(F.col("acceleration_var"), 4).alias("acceleration_variance"),
    )


def accident_counts(accidents: DataFrame) -> DataFrame:
    """Accidents per driver."""
    return accidents.groupBy(F.col("driver_id").try_cast("bigint").alias("driver_id")).agg(
        F.count(F.lit(1)).alias("accident_count")
    )


def training_data(features: DataFrame, accidents: DataFrame) -> DataFrame:
    """Features with the driver's accident count (0 if none) and a 0/1 target."""
    return features.join(accident_counts(accidents), "driver_id", "left").withColumns({
        "has_accident": F.when(F.col("accident_count") > 0, 1).otherwise(0),
        "accident_count": F.coalesce("accident_count", F.lit(0).cast("bigint")),
    })


def _with_refresh_time(rows: DataFrame, features: DataFrame) -> DataFrame:
    seen = features.select(F.col("driver_id").alias("_seen"), "last_updated")
    return rows.join(seen, F.col("driver_id") == F.col("_seen"), "left")


def _is_new(event_time: Column) -> Column:
    since = F.coalesce(F.col("last_updated"), instant(EPOCH_OF_GATE))
    return (event_time > since) | F.col("_seen").isNull()


def zone_map(tel: DataFrame) -> DataFrame:
    """Newest event of each date folder and driver: a small table that merges by maximum."""
    return tel.groupBy("date", "driver_id").agg(F.max("event_ts").alias("latest_event"))


def new_data(tel: DataFrame, features: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Telemetry newer than its driver's last refresh, or of a driver not refreshed yet.

    Rows without a driver match no feature row and so always count as new. The refresh times are
    joined to the zone map (one row per date and driver, kept or made from ``tel``), which tells
    the dates that can hold new rows: no other folder is read. Of those, rows meet only the
    zones of their date and driver; rows without a driver pass around the join.
    """
    zones = zone_map(tel) if zones is None else zones
    news = _with_refresh_time(zones, features).where(_is_new(F.col("latest_event")))
    # At most one value per date of the calendar.
    days = [row["date"] for row in news.select("date").distinct().collect()]
    read = tel.where(F.col("date").isin([day for day in days if day is not None]) | (F.col("date").isNull() & F.lit(None in days)))
    zone = news.where(F.col("driver_id").isNotNull()).select(
        F.col("date").alias("_date"), F.col("driver_id").alias("_driver"), "last_updated", "_seen")
    known = read.where(F.col("driver_id").isNotNull()).join(
        zone, (F.col("driver_id") == F.col("_driver")) & F.col("date").eqNullSafe(F.col("_date")))
    return known.where(_is_new(F.col("event_ts"))).select(*tel.columns).unionAll(
        read.where(F.col("driver_id").isNull()).select(*tel.columns))


def drivers_with_new_data(tel: DataFrame, features: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Drivers that :func:`new_data` has rows for, from one row per driver.

    The gate only asks whether there is anything new, so telemetry (or, without reading any, a
    kept zone map) is reduced to each driver's latest event before the join.
    """
    newest = F.max("event_ts") if zones is None else F.max("latest_event")
    latest = (tel if zones is None else zones).groupBy("driver_id").agg(newest.alias("latest_event"))
    return _with_refresh_time(latest, features).where(_is_new(F.col("latest_event"))) \
        .select("driver_id", "latest_event")
