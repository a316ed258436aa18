"""Customer risk profile and vehicle safety: telemetry and crashes on one key.

Each report exists in two forms. The plain form counts every telemetry row and every crash
once. The ``fanout`` form returns what joining both to the key in one query returns, where
a policy with T telemetry rows and C crashes counts T*C of each; the numbers are computed
from per-key totals, so the T*C rows never exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import customer_name, policy_key
from .activity import SPEEDING_MPH, sort_key, top
from .timespan import trailing

_HARD_G = 2.0
_MEDIUM_G_EVENTS = 10
_MEDIUM_SPEEDING = 20

_AVERAGED = {"g": "g_force", "speed": "speed_mph", "battery": "device_battery_level",
             "accuracy": "gps_accuracy"}


def _telemetry_totals(*averaged: str) -> list[Column]:
    totals = [
        F.count(F.lit(1)).alias("t_rows"),
        F.count("event_ts").alias("t_times"),
        F.count_if(F.col("g_force") > _HARD_G).alias("t_hard"),
        F.count_if(F.col("speed_mph") > SPEEDING_MPH).alias("t_speeding"),
    ]
    for name in averaged:
        totals += [F.sum(_AVERAGED[name]).alias(f"{name}_sum"), F.count(_AVERAGED[name]).alias(f"{name}_n")]
    return totals


def _crash_totals() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("c_rows"),
        F.count("report_id").alias("c_ids"),
        F.max("risk_score").alias("c_risk"),
        F.count_if("emergency_recommended").alias("c_emergency"),
    ]


def _combined(keys: DataFrame, t: DataFrame, c: DataFrame, key: str, fanout: bool) -> DataFrame:
    """Totals of both sides per key row, with weights ``t_weight`` and ``c_weight``.

    A telemetry total counts ``t_weight`` times and a crash total ``c_weight`` times. In
    fan-out form a key's rows multiply: telemetry by its crashes, crashes by its telemetry.
    """
    if fanout:
        rows = keys.join(t, key, "left").join(c, key, "left").fillna(0, ["t_rows", "c_rows"])
        return rows.withColumns({
            "t_weight": F.greatest(F.col("c_rows"), F.lit(1)),
            "c_weight": F.greatest(F.col("t_rows"), F.lit(1)),
        })
    # Both sides are stacked first, so the keys are joined once.
    both = t.unionByName(c, allowMissingColumns=True)
    return keys.join(both, key).withColumns({"t_weight": F.lit(1), "c_weight": F.lit(1)})


def _t(column: str) -> Column:
    return F.coalesce(F.sum(F.col(column) * F.col("t_weight")), F.lit(0))


def _c(column: str) -> Column:
    return F.coalesce(F.sum(F.col(column) * F.col("c_weight")), F.lit(0))


def _mean(name: str) -> Column:
    weight = F.col("t_weight")
    return F.try_divide(F.sum(F.col(f"{name}_sum") * weight), F.sum(F.col(f"{name}_n") * weight))


def customer_risk_profile(
    customers: DataFrame, policies: DataFrame, tel: DataFrame, crash: DataFrame, as_of,
    fanout: bool = False, k: int | None = 20,
) -> DataFrame:
    """Customers with an active policy and telemetry, riskiest first.

    Telemetry (30 days) and crashes (365 days) are reduced to one row per policy, vehicle
    and side before any join, so a policy holding a large share of all events reaches the
    joins as a handful of rows.
    """
    t = (
        trailing(tel, "date", as_of, days=30)
        .groupBy(policy_key(F.col("policy_id")).alias("_policy"), "vin")
        .agg(*_telemetry_totals("g", "speed"))
    )
    c = (
        trailing(crash, "report_date", as_of, days=365)
        .groupBy(policy_key(F.col("policy_id")).alias("_policy"))
        .agg(*_crash_totals())
    )
    holders = (
        policies.where(F.col("status") == "ACTIVE")
        .select(policy_key(F.col("policy_id")).alias("_policy"), "customer_id")
        .join(customers.select("customer_id", "first_name", "last_name", "email"), "customer_id")
    )
    report = (
        _combined(holders, t, c, "_policy", fanout)
        .groupBy("customer_id", "first_name", "last_name", "email")
        .agg(
            F.count_distinct("vin").alias("vehicles_count"),
            _mean("g").alias("avg_g_force"),
            _t("t_hard").alias("high_gforce_events"),
            _mean("speed").alias("avg_speed"),
            _t("t_speeding").alias("speeding_events"),
            _c("c_ids").alias("crash_count"),
            F.max("c_risk").alias("max_crash_risk_score"),
            _c("c_emergency").alias("emergency_crashes"),
            F.sum("t_times").alias("_times"),
        )
        .where(F.col("_times") > 0)
        .select(
            "customer_id", customer_name().alias("customer_name"), "email", "vehicles_count",
            "avg_g_force", "high_gforce_events", "avg_speed", "speeding_events", "crash_count",
            "max_crash_risk_score", "emergency_crashes",
            F.when(F.col("crash_count") > 0, "HIGH_RISK")
            .when((F.col("high_gforce_events") > _MEDIUM_G_EVENTS)
                  | (F.col("speeding_events") > _MEDIUM_SPEEDING), "MEDIUM_RISK")
            .otherwise("LOW_RISK").alias("risk_category"),
        )
    )
    return top(report, k, F.col("crash_count").desc(), F.col("high_gforce_events").desc(),
               F.col("customer_id").asc())


def vehicle_safety(
    vehicles: DataFrame, tel: DataFrame, crash: DataFrame, as_of,
    fanout: bool = False, min_events: int = 100, k: int | None = 15,
) -> DataFrame:
    """Crashes and telemetry averages per make, model and year, most crashes per vehicle first.

    Only groups with more than ``min_events`` distinct event times count. Times are made
    distinct per vehicle first, within each task and then by vehicle and time, so a vehicle that
    holds very many events is spread by its times; models only count what is left.
    """
    model = ["make", "model", "year"]
    events = trailing(tel, "date", as_of, days=90)
    t = events.groupBy("vin").agg(*_telemetry_totals("g", "speed", "battery", "accuracy"))
    c = trailing(crash, "report_date", as_of, days=365).groupBy("vin").agg(*_crash_totals())
    cars = vehicles.select("vin", *model)

    groups = _combined(cars, t, c, "vin", fanout).groupBy(*model).agg(
        F.count_distinct(F.when(F.col("t_rows") > 0, F.col("vin"))).alias("vehicle_count"),
        _mean("g").alias("avg_g_force"),
        _c("c_ids").alias("total_crashes"),
        _mean("speed").alias("avg_speed"),
        _mean("battery").alias("avg_device_health"),
        _mean("accuracy").alias("avg_gps_accuracy"),
    )
    times = (
        events.where(F.col("event_ts").isNotNull() & F.col("vin").isNotNull()).select("vin", "event_ts").distinct()
        .join(cars, "vin").select(*model, "event_ts").distinct()
        .groupBy(*model).agg(F.count(F.lit(1)).alias("_times"))
        .where(F.col("_times") > min_events)
    )
    same_model = [F.col(f"g.{m}").eqNullSafe(F.col(f"o.{m}")) for m in model]
    counted = groups.alias("g").join(times.alias("o"), same_model, "left_semi")
    report = (
        counted
        .select(
            *model, "vehicle_count", "avg_g_force", "total_crashes",
            F.try_divide(F.col("total_crashes").cast("double"), F.col("vehicle_count"))
            .alias("crashes_per_vehicle"),
            "avg_speed", "avg_device_health", "avg_gps_accuracy",
        )
    )
    return top(report, k, sort_key("crashes_per_vehicle").desc_nulls_first(),
               sort_key("avg_g_force").desc_nulls_first(), *[F.col(m).asc_nulls_last() for m in model])
