"""The physical plans that the operators are written for."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from roadledger.operators import scoring, training
from roadledger.plans.table_queries import AS_OF, Tables

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def test_features_shuffle_once_after_partial_aggregation(spark):
    plan = plan_of(training.driver_features(Tables(spark, FOLDER).telemetry, AS_OF))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_" in plan
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double,props:string>" in plan


def test_time_filters_reach_the_scan(spark):
    for name in ("performance_probe", "speeding_analysis", "recent_high_gforce_events"):
        plan = plan_of(entry.queries()[name](spark, FOLDER))
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,", plan), name


def test_top_k_does_not_sort_everything(spark):
    for name in ("top_k", "speeding_analysis", "top_customer_risk", "vehicle_safety"):
        assert "TakeOrderedAndProject" in plan_of(entry.queries()[name](spark, FOLDER)), name


def test_current_scores_cut_rows_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "h")
    spark.range(100).select(
        (F.col("id") % 5).alias("driver_id"), F.col("id").cast("string").alias("score_id"),
        F.lit(50).cast("decimal(5,2)").alias("score"), F.current_timestamp().alias("calculation_date"),
        F.lit("n").alias("notes")).write.parquet(path)
    plan = plan_of(scoring.current_scores(spark.read.parquet(path)))
    partial, shuffle = plan.index("row_number(), 1, Partial"), plan.index("Exchange hashpartitioning")
    assert shuffle < partial  # plans print from the result down


def test_facts_pass_no_shuffle_when_owners_are_small(spark):
    assert "Exchange hashpartitioning" not in plan_of(entry.queries()["telemetry_enriched"](spark, FOLDER))


def test_hot_and_null_keys_are_split_when_owners_are_too_large_to_broadcast(spark):
    """A third of the facts on one vehicle and policy, a third without any."""
    from roadledger.operators import enrich

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    which = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.col("id") % 1000)
    facts = spark.range(0, 300_000, 1, 8).select("id", which.alias("policy_id"), F.concat(F.lit("V"), which).alias("vin"))
    vehicles = spark.range(1000).select(
        F.concat(F.lit("V"), "id").alias("vin"), F.lit("M").alias("make"), F.lit("X").alias("model"),
        F.lit(2020).alias("year"), F.lit("red").alias("color"))
    policies = spark.range(1000).select(
        F.col("id").alias("policy_id"), F.col("id").alias("customer_id"), F.lit("P").alias("policy_number"),
        F.lit("ACTIVE").alias("status"))
    customers = spark.range(1000).select(
        F.col("id").alias("customer_id"), *[F.lit("x").alias(c) for c in ("first_name", "last_name", "email")])
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        out = enrich._with_owner(facts, vehicles, policies, customers, ("first_name", "last_name", "email")) \
            .groupBy("make", "policy_status").count()
        assert sorted((tuple(r) for r in out.collect()), key=repr) == [("M", "ACTIVE", 200_000), (None, None, 100_000)]
        assert plan_of(out).count("SortMergeJoin(skew=true)") >= 2
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_the_summary_view_prunes_date_folders(spark, tmp_path, telemetry_of):
    from roadledger.operators.activity import vehicle_behavior_summary
    from roadledger.sources import telemetry, write_telemetry

    base = str(tmp_path / "t")
    write_telemetry(telemetry_of({"event_ts": "2024-01-15 08:00:00", "event_time": "1705305600", "vin": "V"}), base)
    vehicle_behavior_summary(telemetry(spark, base), by_folder=True).createOrReplaceTempView("summary_by_folder")
    plan = plan_of(spark.sql("select * from summary_by_folder where date = date'2024-01-15'"))
    scan = next(line for line in plan.split("\n") if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(date" in scan
