from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from roadledger import functions as fx


def row(spark, **columns):
    """One row of constants, each given as ``(value, type)``; needs no Python worker."""
    return spark.range(1).select(*[F.lit(v).cast(t).alias(n) for n, (v, t) in columns.items()])


def one(spark, value, column):
    return row(spark, v=(value, "string")).select(column).collect()[0][0]


@pytest.mark.parametrize("g, label", [
    (1.99, "NORMAL"), (2.0, "MODERATE"), (3.99, "MODERATE"), (4.0, "HIGH"), (6.0, "SEVERE"),
    (7.99, "SEVERE"), (8.0, "CRITICAL"), (None, "NORMAL")])
def test_severity_edges(spark, g, label):
    df = row(spark, g=(g, "double"))
    assert df.select(fx.severity_level(F.col("g"))).collect()[0][0] == label


@pytest.mark.parametrize("score, label", [
    ("90.00", "EXCELLENT"), ("89.99", "GOOD"), ("80.00", "GOOD"), ("79.99", "AVERAGE"),
    ("70.00", "AVERAGE"), ("69.99", "POOR"), ("60.00", "POOR"), ("59.99", "HIGH_RISK"), (None, "HIGH_RISK")])
def test_risk_category_edges(spark, score, label):
    assert one(spark, score, fx.risk_category(F.col("v").cast("decimal(5,2)"))) == label


@pytest.mark.parametrize("emergency, risk, label, rank", [
    (True, 90.0, "IMMEDIATE_RESPONSE", 1), (True, 89.9, "URGENT_RESPONSE", 2), (True, 70.0, "URGENT_RESPONSE", 2),
    (True, 69.0, "STANDARD_RESPONSE", 3), (False, 95.0, "STANDARD_RESPONSE", 3), (False, 50.0, "STANDARD_RESPONSE", 3),
    (True, 49.9, "LOW_PRIORITY", 4), (None, 95.0, "STANDARD_RESPONSE", 3), (True, None, "LOW_PRIORITY", 4)])
def test_response_priority(spark, emergency, risk, label, rank):
    df = row(spark, emergency_recommended=(emergency, "boolean"), risk_score=(risk, "double"))
    (got,) = df.select(fx.response_priority(), fx.response_priority(as_rank=True)).collect()
    assert tuple(got) == (label, rank)


@pytest.mark.parametrize("hour, literal, wrapped", [
    (5, "DAYTIME", "NIGHT"), (6, "MORNING_RUSH", "MORNING_RUSH"), (9, "MORNING_RUSH", "MORNING_RUSH"),
    (10, "DAYTIME", "DAYTIME"), (17, "EVENING_RUSH", "EVENING_RUSH"), (20, "DAYTIME", "DAYTIME"),
    (22, "DAYTIME", "NIGHT"), (0, "DAYTIME", "NIGHT")])
def test_time_category(spark, hour, literal, wrapped):
    ts = F.col("v").cast("timestamp")
    text = f"2024-01-07 {hour:02d}:30:00"
    assert one(spark, text, fx.time_category(ts)) == literal
    assert one(spark, text, fx.time_category(ts, wrapped=True)) == wrapped


def test_sunday_is_zero(spark):
    ts = F.col("v").cast("timestamp")
    assert one(spark, "2024-01-07 12:00:00", fx.sunday_zero_weekday(ts)) == 0
    assert one(spark, "2024-01-13 12:00:00", fx.sunday_zero_weekday(ts)) == 6


@pytest.mark.parametrize("raw, expected", [
    ("1.755388814624461E9", "2025-08-17 00:00:14.624461"),
    ("1755388814624", "2025-08-17 00:00:14.624"),
    ("1755388814", "2025-08-17 00:00:14"),
    ("2024-01-15T10:30:45.123Z", "2024-01-15 10:30:45.123"),
    ("not a time", None), ("NaN", None), (None, None)])
def test_event_time_encodings(spark, raw, expected):
    assert one(spark, raw, fx.event_ts(F.col("v")).cast("string")) == expected


@pytest.mark.parametrize("part, whole, percent", [
    (1, 3, "33.33"), (2, 3, "66.67"), (1, 8, "12.50"), (1, 800, "0.13"), (0, 5, "0.00"), (5, 5, "100.00")])
def test_percent_is_half_up(spark, part, whole, percent):
    df = row(spark, p=(part, "bigint"), w=(whole, "bigint"))
    assert df.select(fx.as_percent(F.col("p"), F.col("w"))).collect()[0][0] == Decimal(percent)


def test_rounding_ignores_binary_fractions(spark):
    df = spark.createDataFrame([(1.005,), (2.675,)], "v double")
    assert [r[0] for r in df.select(fx.rounded(F.col("v"), 2)).collect()] == [Decimal("1.01"), Decimal("2.68")]


def test_forces(spark):
    df = spark.createDataFrame([(3.0, 4.0, 12.0, 1.0, 2.0, 2.0)],
                               "accelerometer_x double, accelerometer_y double, accelerometer_z double, "
                               "gyroscope_x double, gyroscope_y double, gyroscope_z double")
    got = fx.with_forces(df).first()
    assert got["calculated_g_force"] == pytest.approx(13 / 9.81)
    assert got["lateral_g_force"] == pytest.approx(5 / 9.81)
    assert got["vertical_g_force"] == pytest.approx((12 - 9.81) / 9.81)
    assert got["gyro_magnitude"] == 3.0


def test_names_propagate_null_but_notes_do_not(spark):
    df = spark.createDataFrame(
        [("Ann", None, "A", "B", 2020, "GOOD", None, None, 3, None)],
        "first_name string, last_name string, make string, model string, vehicle_year int, risk_category string, "
        "accident_count bigint, speed_compliance_rate decimal(5,2), harsh_driving_events bigint, "
        "phone_usage_rate decimal(5,2)")
    name, vehicle, notes = df.select(
        fx.customer_name(), fx.vehicle_description(), fx.weighted_notes()).first()
    assert name is None and vehicle == "A B (2020)"
    assert notes == ("Risk: GOOD | Accidents:  (25%) | Speed: % (30%) | Phone: % (20%) | Harsh: 3 (15%)"
                     " | Model: Weighted Formula v4")


def test_policy_key_and_zone(spark):
    assert one(spark, "200018", fx.policy_key(F.col("v"))) == 200018
    assert one(spark, "POL-7", fx.policy_key(F.col("v"))) is None
    assert one(spark, "33.7505", fx.geo_zone(F.col("v").cast("double"))) == Decimal("33.751")


def test_minutes_since(spark):
    got = one(spark, "2024-01-30 23:59:30", fx.minutes_since(F.col("v").cast("timestamp"), "2024-01-31 00:00:00"))
    assert got == 0.5
