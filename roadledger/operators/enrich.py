"""Telemetry and crash rows with vehicle, policy and customer attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    customer_name,
    minutes_since,
    policy_key,
    response_priority,
    sunday_zero_weekday,
    time_category,
    vehicle_description,
    with_forces,
)
from .timespan import trailing

_PERSON = ("first_name", "last_name", "email")
_CONTACT = ("phone_number", "address", "city", "state", "zip_code")


def _with_owner(facts: DataFrame, vehicles: DataFrame, policies: DataFrame, customers: DataFrame,
                person: tuple[str, ...]) -> DataFrame:
    """Left-join vehicle and policy holder to every fact row.

    Vehicles, policies and customers are joined one after the other, so the planner sees the
    size of each table: what is under the session's limit is broadcast and the facts are not
    moved for it, what is larger is shuffled, with hot or NULL keys split at run time. No side
    is hinted, and no job runs while the plan is built.
    """
    known = [c for c in person if c in customers.columns]
    missing = [F.lit(None).cast("string").alias(c) for c in person if c not in customers.columns]
    cars = vehicles.select("vin", "make", "model", F.col("year").alias("vehicle_year"), "color")
    held = policies.select(
        policy_key(F.col("policy_id")).alias("_policy"), F.col("customer_id").alias("_customer"),
        "policy_number", F.col("status").alias("policy_status"),
    )
    people = customers.select(F.col("customer_id").alias("_customer"), *known, *missing)
    return (
        facts.withColumn("_policy", policy_key(F.col("policy_id")))
        .join(cars, "vin", "left")
        .join(held, "_policy", "left")
        .join(people, "_customer", "left")
        .select(*facts.columns, "make", "model", "vehicle_year", "color",
                "policy_number", "policy_status", *person)
    )


def telemetry_enriched(tel: DataFrame, vehicles: DataFrame, policies: DataFrame,
                       customers: DataFrame) -> DataFrame:
    """Every telemetry row with derived forces, vehicle, policy and customer."""
    return with_forces(_with_owner(tel, vehicles, policies, customers, _PERSON))


def crash_enriched(crash: DataFrame, vehicles: DataFrame, policies: DataFrame,
                   customers: DataFrame, *, wrapped_night: bool = False) -> DataFrame:
    """Every crash report with owner, response priority and time labels."""
    owned = _with_owner(crash, vehicles, policies, customers, _PERSON + _CONTACT)
    return owned.withColumns({
        "response_priority": response_priority(),
        "crash_hour": F.hour("crash_timestamp"),
        "crash_day_of_week": sunday_zero_weekday(F.col("crash_timestamp")),
        "time_category": time_category(F.col("crash_timestamp"), wrapped_night),
    })


def emergency_queue(enriched: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Emergencies of the last ``hours``, with priority as a rank from 1 (most urgent)."""
    return (
        trailing(enriched, "crash_timestamp", as_of, hours=hours, from_midnight=False)
        .where(F.col("emergency_recommended"))
        .select(
            "report_id", "policy_id", "vin", "crash_timestamp", "crash_type", "risk_score",
            "current_street", "crash_latitude", "crash_longitude",
            customer_name().alias("customer_name"), "phone_number",
            vehicle_description().alias("vehicle_description"),
            response_priority(as_rank=True).alias("response_priority"),
            minutes_since(F.col("crash_timestamp"), as_of).alias("minutes_since_crash"),
        )
    )
