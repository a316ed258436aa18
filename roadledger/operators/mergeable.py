"""Driver features in mergeable form, for features that are kept up to date piecewise.

A partial holds counts, means and the sum of squared differences from the mean of one
driver over one piece of telemetry (a day's folder, a window of minutes). Partials merge to
the features of all pieces without the cancellation that sums of squares suffer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import struct
from .training import behaviour_counts, features_of

COUNTS = ("total_events", "violations", "harsh_driving_events", "phone_events", "excessive_speeding_count")
PARTIAL = struct(", ".join(f"{c} BIGINT" for c in COUNTS) + """,
  g_n BIGINT, g_mean DOUBLE, speed_n BIGINT, speed_mean DOUBLE, speed_m2 DOUBLE, speed_max DOUBLE,
  latest_event TIMESTAMP""")


def partial_features(tel: DataFrame, *keys: Column | str) -> DataFrame:
    """One partial per driver and ``keys``; every function is pre-aggregated per task."""
    grouped = tel.groupBy("driver_id", *keys).agg(
        *behaviour_counts(),
        F.count("g_force").alias("g_n"), F.avg("g_force").alias("g_mean"),
        F.count("speed_mph").alias("speed_n"), F.avg("speed_mph").alias("speed_mean"),
        F.var_pop("speed_mph").alias("speed_var"), F.max("speed_mph").alias("speed_max"),
        F.max("event_ts").alias("latest_event"),
    )
    return grouped.withColumn("speed_m2", F.col("speed_var") * F.col("speed_n")).drop("speed_var")


def merge_partials(partials: DataFrame, *keys: str) -> DataFrame:
    """Partials merged to one per ``keys``.

    The merged mean is found by a window over the same keys that the aggregation groups
    by, so the partials are shuffled once. A driver has one partial per day or window of
    minutes, which bounds the group by the calendar however many events it had.
    """
    group = Window.partitionBy(*keys)
    n, mean = F.col("speed_n"), F.col("speed_mean")
    apart = mean - F.col("_mean")
    return (
        partials
        .withColumn("_mean", F.try_divide(F.sum(mean * n).over(group), F.sum(n).over(group)))
        .groupBy(*keys)
        .agg(
            *[F.sum(c).alias(c) for c in COUNTS],
            F.sum("g_n").alias("_g_n"),
            F.try_divide(F.sum(F.col("g_mean") * F.col("g_n")), F.sum("g_n")).alias("g_mean"),
            F.sum(n).alias("_n"),
            F.first("_mean").alias("_speed_mean"),
            F.sum(F.col("speed_m2") + n * apart * apart).alias("speed_m2"),
            F.max("speed_max").alias("speed_max"),
            F.max("latest_event").alias("latest_event"),
        )
        .withColumnsRenamed({"_g_n": "g_n", "_n": "speed_n", "_speed_mean": "speed_mean"})
        .select(*keys, *PARTIAL.names)
    )


def combine_features(partials: DataFrame, as_of) -> DataFrame:
    """Driver features from partials, equal to those of the batch operator."""
    merged = merge_partials(partials.where(F.col("driver_id").isNotNull()), "driver_id")
    spread = F.sqrt(F.col("speed_m2") / (F.col("speed_n") - 1))
    return features_of(
        merged.withColumn("speed_deviation", F.when(F.col("speed_n") > 1, spread)), as_of
    )
