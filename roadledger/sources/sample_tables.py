"""The star-schema sample tables seen as telemetry, crashes, policies and vehicles.

The definitions are plain SQL with the same meaning in Spark and DuckDB: every number that
could become a decimal in one engine and a double in the other is cast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _d(number: float | int | str) -> str:
    return f"cast({number} as double)"


_K = _d("regexp_extract(props, '([0-9]+)', 1)")

SAMPLE_SQL = {
    "telemetry": f"""
select event_id,
  case when event_id % 43 = 0 then null else user_id end as policy_id,
  user_id % 97 as vehicle_id, concat('VIN', cast(user_id % 97 as string)) as vin,
  case when user_id % 50 = 49 then null else user_id end as driver_id,
  cast(ts as timestamp) as event_ts, cast(ts as date) as date,
  case when event_id % 53 = 0 then null
    else least(value, {_d(120)}) * ({_d(0.15)} + {_d("user_id % 10")} / {_d(10)}) end as speed_mph,
  {_d("25 + 10 * (event_id % 5)")} as speed_limit_mph,
  {_K} / (case when user_id % 6 = 0 then {_d(60)} else {_d(12)} end) as g_force,
  concat('St ', cast(event_id % 13 as string)) as current_street,
  case when event_id % 41 = 0 then null
    else {_d(33.75)} + {_d("event_id % 20")} / {_d(1000)} end as gps_latitude,
  {_d(-84.39)} + {_d("event_id % 10")} / {_d(1000)} as gps_longitude,
  {_d(1)} + {_d("event_id % 9")} / {_d(2)} as gps_accuracy,
  {_d("event_id % 7 - 3")} as accelerometer_x, {_d("event_id % 11 - 5")} as accelerometer_y,
  {_d("event_id % 13")} as accelerometer_z,
  {_d("event_id % 3")} as gyroscope_x, {_d("event_id % 5")} as gyroscope_y,
  {_d("event_id % 4")} as gyroscope_z,
  {_d("event_id % 100")} as device_battery_level,
  cast(-50 - event_id % 50 as int) as device_signal_strength,
  event_type = 'view' as device_screen_on, event_id % 2 = 0 as device_charging
from {{events}}""",
    "crash": f"""
select cast(event_id as string) as report_id,
  cast(case when user_id % 3 = 0 then user_id + 1 else user_id end as string) as policy_id,
  concat('VIN', cast(user_id % 97 as string)) as vin,
  cast(ts as timestamp) as crash_timestamp, cast(ts as date) as report_date,
  case event_id % 4 when 0 then 'FRONTAL' when 1 then 'REAR_END' when 2 then 'SIDE'
    else 'ROLLOVER' end as crash_type,
  case when {_K} >= 96 then 'CRITICAL' when {_K} >= 48 then 'HIGH' else 'NORMAL' end as severity_level,
  {_K} / {_d(12)} as total_g_force, value as speed_at_impact,
  case when event_id % 37 = 0 then null
    else {_d(33.75)} + {_d("event_id % 20")} / {_d(1000)} end as crash_latitude,
  {_d(-84.39)} + {_d("event_id % 10")} / {_d(1000)} as crash_longitude,
  concat('St ', cast(event_id % 13 as string)) as current_street,
  event_id % 7 = 0 as rollover_detected, event_id % 5 = 0 as spinning_detected,
  {_K} >= 60 as emergency_recommended, {_K} as risk_score
from {{events}} where event_type = 'error'""",
    "accidents": f"""
select event_id as accident_id, user_id as policy_id,
  user_id % 97 - 9 as vehicle_id, user_id as driver_id,
  cast(ts as timestamp) as accident_timestamp, cast(ts as timestamp) as created_at
from {{events}} where event_type = 'error' and {_K} >= 97""",
    "policies": """
select o_orderkey as policy_id, o_custkey as customer_id,
  concat('POL-', cast(o_orderkey as string)) as policy_number,
  cast(o_orderdate as date) as start_date,
  case o_orderstatus when 'O' then 'ACTIVE' when 'F' then 'EXPIRED' else 'CANCELLED' end as status
from {orders}""",
    "customers": """
select c_custkey as customer_id, c_name as first_name, c_mktsegment as last_name,
  concat(c_name, '@example.com') as email
from {customer}""",
    "vehicles": """
select p_partkey as vehicle_id, p_partkey as policy_id,
  concat('VIN', cast(p_partkey as string)) as vin, p_brand as make, p_type as model,
  2000 + p_size as year, cast(null as string) as color
from {part}""",
    "drivers": """
select c_custkey as driver_id, c_custkey as policy_id,
  c_name as first_name, c_mktsegment as last_name
from {customer}""",
    "claims": f"""
select event_id as claim_id, event_id as accident_id,
  cast(ts as date) as claim_date,
  case event_id % 3 when 0 then 'PENDING' when 1 then 'APPROVED' else 'DENIED' end as status
from {{events}} where event_type = 'error' and {_K} >= 97""",
}

_SOURCE = {"telemetry": "events", "crash": "events", "accidents": "events", "claims": "events",
           "policies": "orders", "customers": "customer", "vehicles": "part", "drivers": "customer"}


# Declared so that reading a table needs no job to infer its schema.
_SCHEMA = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
}


def sample(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the mapped tables over the Parquet files in ``folder``."""
    source = _SOURCE[name]
    files = spark.read.schema(_SCHEMA[source]).parquet(f"{folder}/{source}.parquet")
    return spark.sql(SAMPLE_SQL[name], **{source: files})
