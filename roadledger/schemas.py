"""Declared schemas: files are read with these, never by inference."""

from __future__ import annotations

import re

from pyspark.sql.types import StructType

_TYPES = {"BIGINT": "long", "INT": "integer"}


def struct(columns: str) -> StructType:
    """``name TYPE, name TYPE`` as a schema; unlike ``fromDDL`` it needs no session."""
    out = StructType()
    for column in re.split(r",(?![^(]*\))", columns):
        name, kind = column.split()
        out.add(name, _TYPES.get(kind, kind.lower()))
    return out


def with_columns(schema: StructType, columns: str) -> StructType:
    """A new schema with columns added; ``StructType.add`` would change ``schema`` itself."""
    return StructType([*schema.fields, *struct(columns).fields])


_SENSORS = """
  gps_latitude DOUBLE, gps_longitude DOUBLE, gps_altitude DOUBLE, gps_speed DOUBLE,
  gps_bearing DOUBLE, gps_accuracy DOUBLE, gps_satellite_count INT, gps_fix_time INT,
  accelerometer_x DOUBLE, accelerometer_y DOUBLE, accelerometer_z DOUBLE,
  gyroscope_x DOUBLE, gyroscope_y DOUBLE, gyroscope_z DOUBLE,
  magnetometer_x DOUBLE, magnetometer_y DOUBLE, magnetometer_z DOUBLE, magnetometer_heading DOUBLE,
  barometric_pressure DOUBLE,
  device_battery_level DOUBLE, device_signal_strength INT, device_orientation STRING,
  device_screen_on BOOLEAN, device_charging BOOLEAN
"""
_VEHICLE = """
  policy_id BIGINT, vehicle_id BIGINT, vin STRING, event_time {time},
  speed_mph DOUBLE, speed_limit_mph DOUBLE, current_street STRING, g_force DOUBLE, driver_id BIGINT,
"""

# Columns stored in telemetry files. Speed limit and battery are DOUBLE and ids BIGINT
# because an INT file reads under the wider type while the reverse fails.
TELEMETRY_FILE = struct(_VEHICLE.format(time="STRING") + _SENSORS)
TELEMETRY_FILE_V1 = struct(_VEHICLE.format(time="TIMESTAMP") + _SENSORS)

# What every telemetry operator receives: file columns, decoded time, partition date.
TELEMETRY = struct(_VEHICLE.format(time="STRING") + _SENSORS + ", event_ts TIMESTAMP, date DATE")

_XYZ = struct("x DOUBLE, y DOUBLE, z DOUBLE")
TELEMETRY_JSON = struct("""
  policy_id BIGINT, vehicle_id BIGINT, vin STRING, event_time STRING,
  speed_mph DOUBLE, speed_limit_mph DOUBLE, current_street STRING, g_force DOUBLE, driver_id STRING
""").add("sensors", (
    StructType()
    .add("gps", struct("""latitude DOUBLE, longitude DOUBLE, altitude DOUBLE, speed_ms DOUBLE,
      bearing DOUBLE, accuracy DOUBLE, satellite_count INT, gps_fix_time INT"""))
    .add("accelerometer", _XYZ)
    .add("gyroscope", struct("pitch DOUBLE, roll DOUBLE, yaw DOUBLE"))
    .add("magnetometer", struct("x DOUBLE, y DOUBLE, z DOUBLE, heading DOUBLE"))
    .add("barometric_pressure", "double")
    .add("device", struct("""battery_level DOUBLE, signal_strength INT, orientation STRING,
      screen_on BOOLEAN, charging BOOLEAN"""))
))

_CRASH_BODY = """
  total_g_force DOUBLE, lateral_g_force DOUBLE, vertical_g_force DOUBLE, speed_at_impact DOUBLE,
  deceleration_rate DOUBLE, impact_accel_x DOUBLE, impact_accel_y DOUBLE, impact_accel_z DOUBLE,
  impact_magnitude DOUBLE, crash_latitude DOUBLE, crash_longitude DOUBLE, current_street STRING,
  heading DOUBLE, accuracy_meters DOUBLE,
  accelerometer_raw_x DOUBLE, accelerometer_raw_y DOUBLE, accelerometer_raw_z DOUBLE,
  accelerometer_total_magnitude DOUBLE, accelerometer_lateral_magnitude DOUBLE,
  accelerometer_vertical_magnitude DOUBLE,
  gyroscope_x DOUBLE, gyroscope_y DOUBLE, gyroscope_z DOUBLE, gyroscope_magnitude DOUBLE,
  rollover_detected BOOLEAN, spinning_detected BOOLEAN,
  magnetometer_x DOUBLE, magnetometer_y DOUBLE, magnetometer_z DOUBLE,
  magnetometer_heading_degrees DOUBLE, emergency_recommended BOOLEAN, risk_score DOUBLE,
  processed_timestamp TIMESTAMP
"""
CRASH = struct("""report_id STRING, policy_id STRING, vin STRING, crash_timestamp TIMESTAMP,
  crash_type STRING,""" + _CRASH_BODY)

# Names used inside crash files where they differ from the declared ones.
CRASH_FILE_NAMES = {"crash_timestamp": "accident_timestamp", "crash_type": "accident_type"}

CORE = {
    "customers": struct("""customer_id BIGINT, first_name STRING, last_name STRING, email STRING,
      phone_number STRING, address STRING, city STRING, state STRING, zip_code STRING,
      created_at TIMESTAMP, updated_at TIMESTAMP"""),
    "policies": struct("""policy_id BIGINT, customer_id BIGINT, policy_number STRING, start_date DATE,
      end_date DATE, status STRING, created_at TIMESTAMP, updated_at TIMESTAMP"""),
    "vehicles": struct("""vehicle_id BIGINT, policy_id BIGINT, vin STRING, make STRING, model STRING,
      year INT, color STRING, created_at TIMESTAMP, updated_at TIMESTAMP"""),
    "drivers": struct("""driver_id BIGINT, policy_id BIGINT, first_name STRING, last_name STRING,
      date_of_birth DATE, license_number STRING, created_at TIMESTAMP, updated_at TIMESTAMP"""),
    "accidents": struct("""accident_id BIGINT, policy_id BIGINT, vehicle_id BIGINT, driver_id BIGINT,
      accident_timestamp TIMESTAMP, latitude DECIMAL(10,7), longitude DECIMAL(10,7),
      g_force DECIMAL(4,2), description STRING, created_at TIMESTAMP, updated_at TIMESTAMP"""),
    "claims": struct("""claim_id BIGINT, accident_id BIGINT, claim_date DATE, status STRING,
      amount DECIMAL(10,2), description STRING, created_at TIMESTAMP, updated_at TIMESTAMP"""),
}

SCORE_HISTORY = struct("""score_id STRING, driver_id BIGINT, score DECIMAL(5,2),
  calculation_date TIMESTAMP, notes STRING, calculation_day DATE, run_id STRING""")
