from datetime import date
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roadledger.operators import activity, crashes, enrich, inventory, quality, risk, scoring, timespan, training

AS_OF = "2024-01-31 00:00:00"


def test_single_event_driver(telemetry_of):
    tel = telemetry_of({"driver_id": 1, "event_ts": "2024-01-10 00:00:00", "speed_mph": 30.0, "speed_limit_mph": 25.0,
                        "g_force": 1.5, "device_screen_on": True})
    got = training.driver_features(tel, AS_OF).first()
    assert got["speed_variance"] is None and got["harsh_driving_events"] == 0
    assert (got["speed_compliance_rate"], got["phone_usage_rate"]) == (Decimal("0.00"), Decimal("100.00"))
    none = training.accident_counts(tel.select(F.lit(99).alias("driver_id")))
    examples = training.training_data(training.driver_features(tel, AS_OF), tel.select(F.lit(99).alias("driver_id")))
    assert none.count() == 1
    score = scoring.score_weighted(examples).first()
    # 25 (no accident) + 0 + 0 + 15 + the full 10 for the missing deviation
    assert (score["safe_driver_score"], score["risk_category"]) == (Decimal("50.00"), "HIGH_RISK")


def test_null_speed_counts_as_compliant(telemetry_of):
    tel = telemetry_of(
        {"speed_mph": None}, {"speed_mph": 60.0}, {"speed_mph": 61.0}, {"speed_mph": 50.0},
        driver_id=1, event_ts="2024-01-10 00:00:00", speed_limit_mph=50.0, device_screen_on=True)
    got = training.driver_features(tel.unionByName(telemetry_of({"driver_id": None, "speed_mph": 99.0})), AS_OF).first()
    assert got["total_events"] == 4 and got["speed_compliance_rate"] == Decimal("50.00")
    assert got["excessive_speeding_count"] == 1 and got["phone_usage_rate"] == Decimal("75.00")


def weighted_of(spark, **changes):
    base = {"driver_id": 1, "total_events": 100, "speed_compliance_rate": "100", "avg_g_force": "1.0",
            "harsh_driving_events": 0, "phone_usage_rate": "0", "speed_variance": "6", "accident_count": 0} | changes
    types = {"speed_compliance_rate": "decimal(5,2)", "avg_g_force": "decimal(18,4)", "phone_usage_rate": "decimal(5,2)",
             "speed_variance": "decimal(18,2)"}
    return spark.range(1).select(*[F.lit(v).cast(types.get(c, "bigint")).alias(c) for c, v in base.items()])


@pytest.mark.parametrize("changes, score", [
    ({}, "100.00"), ({"accident_count": 1}, "87.50"), ({"accident_count": 2}, "75.00"), ({"accident_count": 5}, "75.00"),
    ({"phone_usage_rate": "50"}, "80.00"), ({"phone_usage_rate": "80"}, "80.00"),
    ({"harsh_driving_events": 600}, "85.00"), ({"harsh_driving_events": 900}, "85.00"),
    ({"harsh_driving_events": 1}, "99.98"), ({"speed_variance": "21.5"}, "90.00"),
    ({"speed_variance": None}, "100.00"), ({"speed_compliance_rate": "33.35"}, "80.01")])
def test_weighted_score(spark, changes, score):
    assert scoring.score_weighted(weighted_of(spark, **changes)).first()["safe_driver_score"] == Decimal(score)


def test_composite_band_uses_the_unclamped_sum(spark):
    got = scoring.score_composite(weighted_of(spark, avg_g_force="0.0", speed_compliance_rate="70")).first()
    # 0.4*40 + 0.15*150 + 0.15*100 + 0.2*100 + 0.1*100
    assert got["safe_driver_score"] == Decimal("83.50") and got["risk_category"] == "GOOD"
    over = scoring.score_composite(weighted_of(spark, avg_g_force="0.0")).first()
    assert over["safe_driver_score"] == Decimal("100.00") and over["risk_category"] == "EXCELLENT"


def test_probability_of_null_feature_is_null(spark):
    coefficients = [0.5, -0.01, 0.2, 0.01, 0.01, 0.02]
    got = scoring.score_logistic(weighted_of(spark, speed_variance=None), coefficients).first()
    assert got["accident_probability"] is None and got["safe_driver_score"] is None
    assert got["risk_category"] == "HIGH_RISK"


def history_of(spark, *records):
    return spark.createDataFrame([(s, d, Decimal(v), t) for s, d, v, t in records],
                                 "score_id string, driver_id bigint, score decimal(5,2), t string").select(
        "score_id", "driver_id", "score", F.col("t").cast("timestamp").alias("calculation_date"),
        F.lit("n").alias("notes"))


def test_current_score_takes_latest_then_larger_id(spark):
    history = history_of(spark, ("a", 1, "90", "2024-01-01"), ("b", 1, "50", "2024-01-02"),
                         ("c", 1, "60", "2024-01-02"), ("d", 2, "59.99", "2024-01-01"))
    current = scoring.current_scores(history)
    assert rows(current.select("driver_id", "score", "risk_category")) == [
        (1, Decimal("60.00"), "POOR"), (2, Decimal("59.99"), "HIGH_RISK")]
    assert rows(scoring.high_risk_alert(current)) == [(1, "2")]
    assert scoring.score_distribution(current).first()["line"] == \
        "Total: 2 | Excellent: 0 | Good: 0 | Average: 0 | Poor: 1 | High-Risk: 1"


def test_alert_line_is_complete(spark):
    history = history_of(spark, *[(f"s{i}", i, "10", "2024-01-01") for i in (1, 2, 3, 4, 5, 12)])
    alert = rows(scoring.high_risk_alert(scoring.current_scores(history)))
    assert alert == [(6, "1,2,3,4,5,12")]


def test_history_changes_cross_days(spark):
    history = history_of(spark, ("a", 1, "90", "2024-01-01 01:00:00"), ("b", 1, "80", "2024-01-01 02:00:00"),
                         ("c", 1, "85", "2024-01-05 01:00:00"), ("d", 2, "70", "2024-01-05 01:00:00"))
    assert rows(scoring.score_history(history).select("score_id", "previous_score", "change")) == [
        ("a", None, None), ("b", Decimal("90.00"), Decimal("-10.00")), ("c", Decimal("80.00"), Decimal("5.00")),
        ("d", None, None)]


def test_alert_rules(spark):
    df = spark.createDataFrame([(1, 39.99, 4, 31.0), (2, 40.0, 3, 30.0)],
                               "driver_id int, safe_driver_score double, harsh_driving_events int, phone_usage_rate double")
    got = rows(scoring.alerts(df).select("driver_id", "severity", "message"))
    assert got == [(1, "critical", "Driver 1 flagged as HIGH_RISK"), (1, "warning", "Aggressive driving detected for 1"),
                   (1, "warning", "Excessive phone usage: 1")]


def test_new_data_gate(spark, telemetry_of):
    features = spark.createDataFrame([(1, "2024-01-10"), (2, None)], "driver_id bigint, t string") \
        .select("driver_id", F.col("t").cast("timestamp").alias("last_updated"))
    tel = telemetry_of(
        {"driver_id": 1, "event_ts": "2024-01-09 00:00:00"}, {"driver_id": 1, "event_ts": "2024-01-10 00:00:00"},
        {"driver_id": 2, "event_ts": "2024-01-01 00:00:00"}, {"driver_id": 2, "event_ts": "2024-01-01 00:00:01"},
        {"driver_id": 3, "event_ts": "2023-01-01 00:00:00"}, {"driver_id": None, "event_ts": "2023-01-01 00:00:00"})
    assert rows(training.new_data(tel, features).groupBy("driver_id").count()) == [(2, 1), (3, 1), (None, 1)]
    assert {r[0] for r in rows(training.drivers_with_new_data(tel, features))} == {2, 3, None}
    old = tel.where("driver_id = 1")
    assert training.drivers_with_new_data(old, features).isEmpty()


# ---- risk: per-key totals equal the literal joins, also with one hot key -----------------

def risk_inputs(spark, telemetry_of):
    tel = telemetry_of(*[
        {"policy_id": 1 if i % 3 else i % 5, "vin": f"V{i % 4}", "event_ts": f"2024-01-{10 + i % 15:02d} 00:00:{i % 60:02d}",
         "g_force": (i % 50) / 10.0, "speed_mph": None if i % 7 == 0 else float(60 + i % 40),
         "device_battery_level": float(i % 100), "gps_accuracy": 1.0}
        for i in range(600)])
    crash = spark.createDataFrame(
        [(f"r{i}" if i % 6 else None, str(i % 7), f"V{i % 5}", float(i), i % 2 == 0, date(2024, 1, 5)) for i in range(40)],
        "report_id string, policy_id string, vin string, risk_score double, emergency_recommended boolean, report_date date")
    policies = spark.createDataFrame([(i, i // 2, "ACTIVE" if i != 4 else "EXPIRED") for i in range(9)],
                                     "policy_id int, customer_id int, status string")
    customers = spark.createDataFrame([(i, f"F{i}", f"L{i}", f"{i}@x") for i in range(5)],
                                      "customer_id int, first_name string, last_name string, email string")
    vehicles = spark.createDataFrame([(f"V{i}", "M" if i < 3 else None, "X", 2020) for i in range(6)],
                                     "vin string, make string, model string, year int")
    return tel, crash, policies, customers, vehicles


def test_customer_fanout_equals_the_literal_join(spark, telemetry_of):
    tel, crash, policies, customers, _ = risk_inputs(spark, telemetry_of)
    got = risk.customer_risk_profile(customers, policies, tel, crash, AS_OF, fanout=True, k=None)
    t = tel.select(F.col("policy_id").alias("tp"), F.col("vin").alias("tv"), "g_force", "speed_mph", "event_ts")
    c = crash.select(F.col("policy_id").alias("cp"), "report_id", "risk_score", "emergency_recommended")
    literal = (
        customers.join(policies.where("status = 'ACTIVE'"), "customer_id")
        .join(t, F.col("policy_id") == F.col("tp"), "left")
        .join(c, F.col("policy_id").cast("string") == F.col("cp"), "left")
        .groupBy("customer_id").agg(
            F.count_distinct("tv").alias("v"), F.round(F.avg("g_force"), 6).alias("g"),
            F.count_if(F.col("g_force") > 2).alias("h"), F.round(F.avg("speed_mph"), 6).alias("s"),
            F.count_if(F.col("speed_mph") > 80).alias("f"), F.count("report_id").alias("n"),
            F.max("risk_score").alias("m"), F.count_if("emergency_recommended").alias("e"),
            F.count_distinct("event_ts").alias("times")).where("times > 0").drop("times"))
    assert rows(got.select("customer_id", "vehicles_count", F.round("avg_g_force", 6), "high_gforce_events",
                           F.round("avg_speed", 6), "speeding_events", "crash_count", "max_crash_risk_score",
                           "emergency_crashes")) == rows(literal)


def test_customer_profile_counts_everything_once(spark, telemetry_of):
    tel, crash, policies, customers, _ = risk_inputs(spark, telemetry_of)
    got = risk.customer_risk_profile(customers, policies, tel, crash, AS_OF, k=None)
    active = policies.where("status = 'ACTIVE'")
    harsh = active.join(tel, "policy_id").where("g_force > 2").groupBy("customer_id").count()
    assert rows(got.where("high_gforce_events > 0").select("customer_id", "high_gforce_events")) == rows(harsh)
    crashes_ = active.join(crash.withColumn("policy_id", F.col("policy_id").cast("int")), "policy_id") \
        .groupBy("customer_id").agg(F.count("report_id"))
    assert set(rows(got.where("crash_count > 0").select("customer_id", "crash_count"))) <= set(rows(crashes_))


@pytest.mark.parametrize("fanout", [False, True])
@pytest.mark.parametrize("limit", [5, 100, 134, 135, 200, 100_000])
def test_vehicle_groups_are_decided_exactly(spark, telemetry_of, fanout, limit):
    """Group M has 135 distinct times in many more rows; whatever the limit, the answer is exact."""
    tel, crash, _, _, vehicles = risk_inputs(spark, telemetry_of)
    many = tel.crossJoin(spark.range(3)).drop("id")
    times = vehicles.join(many, "vin").groupBy("make").agg(F.count_distinct("event_ts").alias("n"))
    expected = {r["make"] for r in times.collect() if r["n"] > limit}
    got = risk.vehicle_safety(vehicles, many, crash, AS_OF, fanout=fanout, min_events=limit, k=None)
    assert {r["make"] for r in got.collect()} == expected


def test_vehicle_fanout_equals_the_literal_join(spark, telemetry_of):
    tel, crash, _, _, vehicles = risk_inputs(spark, telemetry_of)
    got = risk.vehicle_safety(vehicles, tel, crash, AS_OF, fanout=True, min_events=1, k=None)
    t = tel.select(F.col("vin").alias("tv"), "g_force", "speed_mph", "event_ts")
    c = crash.select(F.col("vin").alias("cv"), "report_id")
    literal = (
        vehicles.join(t, F.col("vin") == F.col("tv"), "left").join(c, F.col("vin") == F.col("cv"), "left")
        .groupBy("make", "model", "year").agg(
            F.count_distinct("tv").alias("v"), F.round(F.avg("g_force"), 6).alias("g"), F.count("report_id").alias("n"),
            F.count_distinct("event_ts").alias("times")).where("times > 1").drop("times"))
    assert rows(got.select("make", "model", "year", "vehicle_count", F.round("avg_g_force", 6), "total_crashes")) == \
        rows(literal)


# ---- enrichment, reports, inventory, quality ---------------------------------------------

def test_enrichment_keeps_unmatched_rows_and_both_join_ways_agree(spark, telemetry_of):
    tel, _, policies, customers, vehicles = risk_inputs(spark, telemetry_of)
    tel = tel.unionByName(telemetry_of({"policy_id": None, "vin": None, "g_force": 1.0}))
    policies = policies.withColumn("policy_number", F.lit("P"))
    vehicles = vehicles.withColumn("color", F.lit(None).cast("string"))
    small = enrich.telemetry_enriched(tel, vehicles, policies, customers)
    assert small.count() == tel.count()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = enrich.telemetry_enriched(tel, vehicles, policies, customers)
        assert rows(small) == rows(large)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_emergency_queue_window_is_exact(spark):
    crash = spark.createDataFrame(
        [("in", "2024-01-30 00:00:00", True, 95.0), ("out", "2024-01-29 23:59:59", True, 95.0),
         ("no", "2024-01-30 10:00:00", False, 95.0), ("null", "2024-01-30 10:00:00", None, 95.0)],
        "report_id string, t string, emergency_recommended boolean, risk_score double").select(
        "*", F.col("t").cast("timestamp").alias("crash_timestamp"),
        *[F.lit(None).cast("string").alias(c) for c in
          ("policy_id", "vin", "crash_type", "current_street", "crash_latitude", "crash_longitude", "first_name",
           "last_name", "phone_number", "make", "model", "vehicle_year")])
    assert rows(enrich.emergency_queue(crash, AS_OF).select("report_id", "response_priority", "minutes_since_crash")) == [
        ("in", 1, 1440.0)]


def test_hotspots_join_distinct_streets_in_order(spark):
    crash = spark.createDataFrame(
        [(1.0004, 2.0, s, r) for s, r in (("B", 1.0), ("A", 2.0), ("B", 4.0), (None, None))] + [(9.0, 9.0, "Z", 1.0)],
        "crash_latitude double, crash_longitude double, current_street string, risk_score double").select(
        "*", F.lit(True).alias("emergency_recommended"), F.current_timestamp().alias("crash_timestamp"))
    (got,) = crashes.crash_hotspots(crash).select("lat_zone", "crash_count", "streets", F.round("avg_risk_score", 6)).collect()
    assert (float(got[0]), got[1], got[2], got[3]) == (1.0, 4, "A, B", round(7 / 3, 6))


def test_trailing_windows(telemetry_of):
    tel = telemetry_of({"event_ts": "2024-01-24 00:00:00"}, {"event_ts": "2024-01-23 23:59:59"}, {"event_ts": "2024-01-30 05:00:00"})
    assert timespan.trailing(tel, "date", "2024-01-31 15:00:00", days=7).count() == 2
    assert timespan.recent_events(tel, "2024-01-31 04:00:00", hours=24).count() == 1
    assert timespan.recent_events(tel, "2024-01-31 06:00:00", hours=24, from_midnight=False).count() == 0


def test_approximate_freshness_is_near(spark, telemetry_of):
    tel = telemetry_of(*[{"policy_id": i, "event_ts": "2024-01-10 00:00:00"} for i in range(500)])
    exact, near = activity.data_freshness(tel).first(), activity.data_freshness(tel, approximate=True).first()
    assert exact["unique_policies"] == 500 and abs(near["unique_policies"] - 500) < 50


def test_inventory_reports(spark):
    mb = 1024 * 1024
    files = spark.createDataFrame(
        [(f"/b/date=2024-01-{d:02d}/telemetry-{i}.parquet", size, date(2024, 1, d))
         for d, n, size in ((1, 4, 100), (2, 5, 100), (3, 6, 64 * mb), (4, 11, 100)) for i in range(n)],
        "path string, bytes bigint, date date")
    got = rows(inventory.compaction_preview(files).select("date", "files", "files_after", "reduction_percent", "grade"))
    assert [g[1:] for g in got] == [(4, None, None, "below minimum"), (5, 1, 80, "eligible"),
                                    (6, 3, 50, "good"), (11, 1, 90, "excellent")]
    floor = inventory.compaction_preview(files, target_mb=100, round_up=False).where("files = 6").first()
    assert floor["files_after"] == 3
    totals = rows(inventory.running_total(inventory.partition_inventory(files)))
    assert [t[1:] for t in totals] == [(4, 4), (5, 9), (6, 15), (11, 26)]
    assert rows(inventory.folder_sizes(files, "/b"))[:2] == [
        (0, "", 26, 4 * 100 + 5 * 100 + 6 * 64 * mb + 11 * 100), (1, "date=2024-01-01", 4, 400)]


def test_running_total_crosses_months(spark):
    inv = spark.createDataFrame([(date(2023, 12, 31), 1), (date(2024, 1, 1), 2), (date(2024, 1, 2), 3),
                                 (date(2024, 3, 1), 4)], "date date, files bigint")
    assert [r[1:] for r in rows(inventory.running_total(inv))] == [(1, 1), (2, 3), (3, 6), (4, 10)]


@pytest.mark.parametrize("small, health", [(0, "healthy"), (9, "acceptable"), (10, "moderate"), (99, "moderate"), (100, "high")])
def test_cleanup_health(spark, small, health):
    files = spark.range(small + 1).select(
        F.lit("p").alias("path"), F.when(F.col("id") < small, 1024).otherwise(9000).cast("bigint").alias("bytes"))
    got = inventory.cleanup_report(files).first()
    assert (got["small_files"], got["health"], got["small_from_1kb"]) == (small, health, small + 1)
    assert got["bytes_before"] - got["bytes_freed"] == got["bytes_after"] == 9000


def test_quality_reports(spark):
    policies = spark.createDataFrame([(1, "ACTIVE"), (2, "OPEN"), (2, None)], "policy_id int, status string")
    drivers = spark.createDataFrame([(1, 1), (2, 9), (3, 9), (4, None)], "driver_id int, policy_id int")
    assert rows(quality.orphans(drivers, policies, "policy_id", "policy_id")) == [(2, 9), (3, 9)]
    report = quality.orphan_report({"policies": policies, "drivers": drivers})
    assert rows(report) == [("drivers.policy_id -> policies.policy_id", 2, 1)]
    assert rows(quality.duplicates(policies, ["policy_id"])) == [(2, 2)]
    rules = [quality.required("status"), quality.one_of("status", "ACTIVE"), quality.exactly("status", 6)]
    assert rows(quality.domain_report(policies, rules).select("rule", "broken_rows")) == [
        ("in ACTIVE", 1), ("length = 6", 1), ("not null", 1)]
