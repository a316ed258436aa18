"""Nested JSON telemetry events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import day_of, event_ts
from ..schemas import TELEMETRY, TELEMETRY_JSON

# Where each flat column sits in the nested event.
_FLAT = {
    "gps_latitude": "gps.latitude", "gps_longitude": "gps.longitude",
    "gps_altitude": "gps.altitude", "gps_speed": "gps.speed_ms", "gps_bearing": "gps.bearing",
    "gps_accuracy": "gps.accuracy", "gps_satellite_count": "gps.satellite_count",
    "gps_fix_time": "gps.gps_fix_time",
    "accelerometer_x": "accelerometer.x", "accelerometer_y": "accelerometer.y",
    "accelerometer_z": "accelerometer.z",
    "gyroscope_x": "gyroscope.pitch", "gyroscope_y": "gyroscope.roll", "gyroscope_z": "gyroscope.yaw",
    "magnetometer_x": "magnetometer.x", "magnetometer_y": "magnetometer.y",
    "magnetometer_z": "magnetometer.z", "magnetometer_heading": "magnetometer.heading",
    "barometric_pressure": "barometric_pressure",
    "device_battery_level": "device.battery_level", "device_signal_strength": "device.signal_strength",
    "device_orientation": "device.orientation", "device_screen_on": "device.screen_on",
    "device_charging": "device.charging",
}


def flatten_telemetry(df: DataFrame) -> DataFrame:
    """Nested events as canonical flat telemetry; ``DRIVER-400018`` becomes 400018."""
    ts = event_ts(F.col("event_time"))
    return df.withColumns({
        "driver_id": F.regexp_extract(F.col("driver_id"), r"(\d+)$", 1).try_cast("bigint"),
        "event_ts": ts,
        "date": day_of(ts),
        **{flat: F.col(f"sensors.{nested}") for flat, nested in _FLAT.items()},
    }).select(*TELEMETRY.names)


def telemetry_json(spark: SparkSession, path: str) -> DataFrame:
    """Flat telemetry from files with one JSON event per line."""
    return flatten_telemetry(spark.read.schema(TELEMETRY_JSON).json(path))


def parse_telemetry(df: DataFrame, column: str = "value") -> DataFrame:
    """Flat telemetry from a text column holding one JSON event per row."""
    parsed = df.select(F.from_json(F.col(column), TELEMETRY_JSON).alias("event"))
    return flatten_telemetry(parsed.select("event.*"))
