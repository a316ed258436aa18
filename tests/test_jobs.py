"""Refresh, streams, views, reports and the command line over files."""

import os
import re
import shutil
from datetime import datetime
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roadledger import __main__ as cli
from roadledger.functions import instant
from roadledger.operators import scoring, training
from roadledger.operators.mergeable import combine_features
from roadledger.plans.catalog import register_views
from roadledger.plans.refresh import RefreshConfig, refresh, retrain_only
from roadledger.plans.reports import standard_reports
from roadledger.plans.table_queries import Tables
from roadledger.sources import load_core, read_scores, telemetry, write_telemetry
from roadledger.sources.paths import Files
from roadledger.streaming import (
    feature_windows,
    merged_windows,
    stream_features,
    stream_high_gforce,
    stream_scores,
)
from roadledger.streaming import jobs
from roadledger.streaming.jobs import read_windows, telemetry_stream

SF = "/root/testdata/sf0.001"
WEDNESDAY = datetime(2024, 1, 31)


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """Telemetry, core tables and crashes of the smallest sample, as files."""
    root = str(tmp_path_factory.mktemp("world"))
    tables = Tables(spark, SF)
    for name, df in tables.core().items():
        df.write.parquet(f"{root}/core/{name}")
    tables.crash.withColumnsRenamed({"crash_timestamp": "accident_timestamp", "crash_type": "accident_type"}) \
        .write.partitionBy("severity_level", "report_date").parquet(f"{root}/crashes")
    return root, tables


def write_part(tables, base, condition):
    part = tables.telemetry.where(condition).withColumn(
        "event_time", (F.unix_micros("event_ts").cast("decimal(20,0)") / 1000000).cast("string"))
    write_telemetry(part, base)


def config_in(world, tmp_path):
    root, _ = world
    return RefreshConfig(telemetry=str(tmp_path / "t"), core=f"{root}/core", home=str(tmp_path / "home"))


def test_refresh_end_to_end(spark, world, tmp_path):
    _, tables = world
    config = config_in(world, tmp_path)
    write_part(tables, config.telemetry, "date < '2024-01-20'")
    first = refresh(spark, config, datetime(2024, 1, 20))
    assert (first.status, first.retrained) == ("REFRESHED", False)
    n = first.current.count()
    assert read_scores(spark, config.history).count() == n
    assert first.statistics.first()["total_drivers"] == n

    assert refresh(spark, config, datetime(2024, 1, 21)).status == "NO_NEW_DATA"
    write_part(tables, config.telemetry, "date >= '2024-01-20'")
    second = refresh(spark, config, WEDNESDAY)
    assert second.status == "REFRESHED" and not second.retrained
    expected = scoring.score_weighted(
        training.training_data(training.driver_features(telemetry(spark, config.telemetry), WEDNESDAY),
                               load_core(spark, config.core)["accidents"]))
    assert rows(second.current.select("driver_id", "score", "risk_category")) == \
        rows(expected.select("driver_id", "safe_driver_score", "risk_category"))

    size = read_scores(spark, config.history).count()
    forced = refresh(spark, config, WEDNESDAY, force=True)
    assert forced.retrained
    # The weighted run is replaced, the model run is added and is the current one.
    assert read_scores(spark, config.history).count() == size + n
    assert forced.current.where(F.col("notes").contains("(Retrained)")).count() == n
    assert forced.current.select(F.max("calculation_date").cast("string")).first()[0] == "2024-01-31 00:00:01"
    model = retrain_only(spark, config, max_iter=15).first()
    assert len(model["coef"]) == 6


@pytest.mark.parametrize("day, retrained", [(datetime(2024, 2, 4), True), (datetime(2024, 3, 3), False)])
def test_sunday_retrains_after_recent_accidents(spark, world, tmp_path, day, retrained):
    _, tables = world
    config = config_in(world, tmp_path)
    write_part(tables, config.telemetry, "true")
    recent = load_core(spark, config.core)["accidents"].where(
        F.col("created_at") > instant(day) - F.expr("INTERVAL '7' DAY")).count() > 0
    done = refresh(spark, config, day)
    assert day.isoweekday() == 7 and done.retrained == recent
    if not retrained:
        assert not done.retrained


def test_refresh_repairs_an_interrupted_swap(spark, world, tmp_path):
    _, tables = world
    config = config_in(world, tmp_path)
    write_part(tables, config.telemetry, "driver_id is not null")
    refresh(spark, config, WEDNESDAY)
    Files(spark, config.home).rename(config.features, config.features + "__old")
    assert refresh(spark, config, datetime(2024, 2, 1)).status == "NO_NEW_DATA"


def test_alert_stream_equals_batch(spark, world, tmp_path):
    from roadledger.operators.activity import high_gforce_events

    _, tables = world
    base, out = str(tmp_path / "t"), str(tmp_path / "out")
    for condition in ("date < '2024-01-10'", "date >= '2024-01-10'"):
        write_part(tables, base, condition)
        stream_high_gforce(telemetry_stream(spark, base), f"{out}/sink", f"{out}/ck", every=None).awaitTermination()
    columns = ["policy_id", "vin", "event_ts", "g_force", "severity_level"]
    got = spark.read.parquet(f"{out}/sink").select(columns)
    assert rows(got) == rows(high_gforce_events(telemetry(spark, base)).select(columns))


def test_feature_stream_equals_batch_over_several_batches(spark, world, tmp_path):
    _, tables = world
    base, out = str(tmp_path / "t"), str(tmp_path / "out")
    # The second part continues windows of the first: half of a day's minute each.
    for condition in ("date < '2024-01-15'", "date >= '2024-01-15' and event_id % 2 = 0",
                      "date >= '2024-01-15' and event_id % 2 = 1"):
        write_part(tables, base, condition)
        stream_features(telemetry_stream(spark, base), f"{out}/w", f"{out}/ck", every=None) \
            .awaitTermination()
    windows = merged_windows(read_windows(spark, f"{out}/w"))
    assert rows(combine_features(windows, WEDNESDAY)) == \
        rows(training.driver_features(telemetry(spark, base), WEDNESDAY))
    assert len([n for n in os.listdir(f"{out}/w") if n.startswith("batch_id=")]) == 3


def test_readers_of_many_batches_read_few_folders(spark, world, tmp_path, monkeypatch):
    _, tables = world
    base, out = str(tmp_path / "t"), str(tmp_path / "out")
    monkeypatch.setattr(jobs, "TIER", 2)
    write_part(tables, base, "date < '2024-01-08'")
    stream_features(telemetry_stream(spark, base, max_files=1), f"{out}/w", f"{out}/ck", every=None).awaitTermination()
    batches = len([n for n in os.listdir(f"{out}/w") if n.startswith("batch_id=")])
    assert batches >= 5
    folders = jobs.tier_folders(spark, f"{out}/w", batches - 1)
    assert len(folders) == bin(batches).count("1") < batches
    expected = rows(training.driver_features(telemetry(spark, base), WEDNESDAY))
    assert rows(combine_features(merged_windows(read_windows(spark, f"{out}/w")), WEDNESDAY)) == expected
    # A merged folder whose write did not finish is replaced by its parts.
    biggest = next(f for f in folders if "/level=" in f)
    os.remove(f"{biggest}/_SUCCESS")
    assert biggest not in jobs.tier_folders(spark, f"{out}/w", batches - 1)
    assert rows(combine_features(merged_windows(read_windows(spark, f"{out}/w")), WEDNESDAY)) == expected


def test_a_thousand_batches_are_read_from_a_bounded_number_of_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs.Files, "exists", lambda self, name: True)
    for last in (0, 15, 16, 999, 4095, 100_000):
        folders = jobs.tier_folders(spark, str(tmp_path), last)
        held = sorted(k for f in folders for level, n in [_level(f)] for k in range(n * 16**level, (n + 1) * 16**level))
        assert held == list(range(last + 1)) and len(folders) <= 15 * 5


def _level(folder):
    found = re.search(r"batch_id=(\d+)$|level=(\d+)/part=(\d+)$", folder)
    return (0, int(found[1])) if found[1] else (int(found[2]), int(found[3]))


def test_one_changed_day_merges_one_month_again(spark, world, tmp_path):
    from roadledger.plans.days import update_days

    _, tables = world
    base, home = str(tmp_path / "t"), str(tmp_path / "home")
    moved = tables.telemetry.where("date < '2024-01-06'")
    for months in (0, 1, 2):
        shifted = moved.withColumn("event_ts", F.expr(f"event_ts + interval {months} month")).withColumn(
            "date", F.add_months("date", months).cast("date"))
        write_part(SimpleNamespace(telemetry=shifted), base, "true")
    first = update_days(spark, base, home)
    assert first.merged == ["2024-01", "2024-02", "2024-03"]
    first.settle()
    assert update_days(spark, base, home).merged == []
    late = moved.where("driver_id = 3").withColumn("date", F.lit("2024-02-03").cast("date"))
    write_part(SimpleNamespace(telemetry=late), base, "true")
    again = update_days(spark, base, home)
    assert again.merged == ["2024-02"] and [str(d) for d in again.changed] == ["2024-02-03"]
    again.settle()
    assert rows(combine_features(again.months, WEDNESDAY)) == rows(training.driver_features(telemetry(spark, base), WEDNESDAY))
    for day in ("01", "02", "03", "04", "05"):
        shutil.rmtree(f"{base}/date=2024-03-{day}", ignore_errors=True)
    gone = update_days(spark, base, home)
    assert gone.merged == ["2024-03"]
    assert rows(combine_features(gone.months, WEDNESDAY)) == rows(training.driver_features(telemetry(spark, base), WEDNESDAY))


def test_snapshot_of_scores_reads_new_runs_only(spark, tmp_path):
    from roadledger.functions import instant, weighted_notes
    from roadledger.plans.snapshot import refreshed_scores
    from roadledger.sources import append_scores

    path, saved = str(tmp_path / "h"), str(tmp_path / "s")

    def run(name, at, **scores):
        made = spark.createDataFrame([(int(k[1:]), float(v)) for k, v in scores.items()], "driver_id long, score double").selectExpr(
            "driver_id", "cast(score as decimal(5,2)) as safe_driver_score", "'GOOD' as risk_category", "1 as accident_count",
            "1.0 as speed_compliance_rate", "1.0 as phone_usage_rate", "1 as harsh_driving_events")
        append_scores(made, path, name, instant(at), weighted_notes())

    def check(*read):
        done = refreshed_scores(spark, path, saved)
        assert [r.split("run_id=")[1] for r in done.read] == list(read)
        assert rows(done.scores) == rows(scoring.current_scores(read_scores(spark, path)))

    check()
    run("a", "2024-01-10 00:00:00", d1=50, d2=60, d3=70)
    check("a")
    check()
    run("b", "2024-01-11 00:00:00", d1=55, d2=65)
    run("c", "2024-01-12 00:00:00", d2=66, d4=80)
    check("b", "c")
    run("c", "2024-01-12 00:00:00", d4=81)  # written again, without driver 2
    check("c")
    shutil.rmtree(f"{path}/calculation_day=2024-01-11")
    check()


def test_gate_reads_only_folders_with_new_rows(spark, world, tmp_path):
    _, tables = world
    base = str(tmp_path / "t")
    write_part(tables, base, "driver_id is not null")
    tel = telemetry(spark, base)
    known = training.driver_features(tel, "2024-01-20 00:00:00")
    zones = training.zone_map(tel)
    news = training.new_data(tel, known, zones)
    wanted = tel.where("event_ts > '2024-01-20 00:00:00'")
    assert rows(news) == rows(wanted) and news.count() > 0
    assert "date#" in news._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert min(str(r["date"]) for r in news.select("date").distinct().collect()) >= "2024-01-20"
    # Unknown drivers and rows without a driver are new whatever their date.
    half = known.where("driver_id % 2 = 0")
    write_part(tables, base, "driver_id is null")
    tel = telemetry(spark, base)
    expected = tel.join(half.select("driver_id", F.lit(1).alias("known")), "driver_id", "left").where(
        "known is null or event_ts > '2024-01-20 00:00:00'").select(tel.columns)
    assert rows(training.new_data(tel, half)) == rows(expected)


def test_bitmaps_of_pieces_unite(spark, telemetry_of):
    from roadledger.operators import activity

    made = [{"policy_id": p, "event_ts": f"2024-01-{10 + d} 0{h}:00:00"}
            for p, d, h in ((1, 0, 1), (1, 0, 2), (40_000, 0, 3), (1, 1, 1), (-5, 1, 4), (None, 2, 1), (2**40, 2, 5))]
    whole, a, b = telemetry_of(*made), telemetry_of(*made[:3]), telemetry_of(*made[3:])
    united = activity.freshness_of(activity.policy_bitmaps(a).unionAll(activity.policy_bitmaps(b)))
    assert rows(united) == rows(activity.data_freshness(whole))
    assert tuple(united.first())[2:] == (3, 4)
    assert tuple(activity.data_freshness(whole.limit(0)).first()) == (None, None, 0, 0)
    for report in (activity.data_freshness(whole), activity.data_completeness(
            whole, whole.select("policy_id", "vin", F.col("date").alias("report_date"), F.lit(None).cast("double").alias("crash_latitude"),
                                F.lit(1.0).alias("risk_score")), "2024-01-31")):
        assert "Expand" not in report._jdf.queryExecution().executedPlan().toString()


def test_rescoring_stream_touches_only_changed_drivers_and_repeats_safely(spark, world, tmp_path):
    _, tables = world
    base, out = str(tmp_path / "t"), str(tmp_path / "out")
    accidents = load_core(spark, f"{world[0]}/core")["accidents"]

    def run():
        stream_features(telemetry_stream(spark, base), f"{out}/w", f"{out}/ck", every=None) \
            .awaitTermination()
        stream_scores(spark, f"{out}/w", accidents, f"{out}/h", f"{out}/sck", every=None).awaitTermination()

    write_part(tables, base, "date < '2024-01-20'")
    run()
    first = read_scores(spark, f"{out}/h")
    drivers = first.count()
    write_part(tables, base, "date >= '2024-01-20' and driver_id = 3")
    run()
    assert read_scores(spark, f"{out}/h").count() == drivers + 1
    expected = scoring.score_weighted(training.training_data(
        training.driver_features(telemetry(spark, base), WEDNESDAY), accidents))
    current = scoring.current_scores(read_scores(spark, f"{out}/h"))
    assert rows(current.select("driver_id", "score")) == rows(expected.select("driver_id", "safe_driver_score"))


def test_merging_windows_does_not_cancel(spark, telemetry_of):
    """Speeds far from zero with a tiny spread, where sums of squares lose every digit."""
    tel = telemetry_of(*[{"driver_id": 1, "event_ts": f"2024-01-10 00:{i:02d}:00", "speed_mph": 1e8 + i % 2}
                         for i in range(60)])
    batch = training.driver_features(tel, WEDNESDAY).first()
    merged = combine_features(feature_windows(tel), WEDNESDAY).first()
    assert float(batch["speed_variance"]) == float(merged["speed_variance"]) == 0.5


def test_views_answer_sql(spark, world):
    root, tables = world
    from roadledger.sources import crash_reports

    core = {**load_core(spark, f"{root}/core")}
    names = register_views(tables.telemetry, crash_reports(spark, f"{root}/crashes"), core, "2024-01-31 00:00:00",
                           tables.history())
    assert {"v_vehicle_telemetry_enriched", "v_high_gforce_events", "v_vehicle_behavior_summary",
            "v_crash_reports_enriched", "v_emergency_response_queue", "v_crash_patterns", "v_crash_hotspots",
            "v_current_driver_scores"} <= set(names)
    for name in names:
        spark.table(name).limit(1).collect()
    top = spark.sql("""select policy_id, event_time, g_force from v_high_gforce_events
                       where event_time >= date'2024-01-31' - interval '24 hours' order by g_force desc limit 20""")
    assert 0 < top.count() <= 20
    ordered = [r[0] for r in spark.sql("select g_force from v_high_gforce_events limit 5").collect()]
    assert ordered == sorted(ordered, reverse=True)


def test_every_standard_report_runs(spark, world):
    root, tables = world
    from roadledger.sources import crash_reports

    reports = standard_reports(tables.telemetry, crash_reports(spark, f"{root}/crashes"),
                               load_core(spark, f"{root}/core"), "2024-01-31 00:00:00")
    assert len(reports) == 15
    for name, make in reports.items():
        assert len(make().collect()) > 0 or name in ("vehicle_safety", "emergency_queue"), name


def test_command_line(spark, world, tmp_path, capsys):
    root, tables = world
    base = str(tmp_path / "t")
    for i in range(5):
        write_part(tables, base, f"date = '2024-01-15' and event_id % 5 = {i}")
    core = ["--core", f"{root}/core"]

    def run(*argv):
        code = cli.run(cli.parser().parse_args(list(argv)), spark)
        return code, capsys.readouterr().out

    assert "eligible" in run("preview", "--base", base, "--date", "2024-01-15")[1]
    code, out = run("compact", "--base", base, "--date", "2024-01-15", "--days-back", "1", "--target-size", "256MB",
                    "--dry-run")
    assert code == 0 and "PLANNED" in out and "SKIPPED" in out
    code, out = run("compact", "--base", base, "--date", "2024-01-15")
    assert code == 0
    assert "running_total" in run("inventory", "--base", base, "--saved", str(tmp_path / "s"))[1]
    assert "would delete 0 files" in run("cleanup", "--base", base, "--dry-run")[1]
    home = ["--telemetry", base, *core, "--home", str(tmp_path / "home"), "--as-of", "2024-01-31"]
    assert "REFRESHED" in run("refresh", *home, "--force")[1]
    assert "coef" in run("train", *home)[1]
    assert "earliest_record" in run("report", "--telemetry", base, "--crashes", f"{root}/crashes", *core,
                                    "--name", "data_freshness", "--as-of", "2024-01-31")[1]
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["compact", "--base", base, "--date", "15.1.2024"])


def test_only_changed_days_are_read_again(spark, world, tmp_path):
    import shutil

    from roadledger.plans import compaction
    from roadledger.plans.days import update_days

    _, tables = world
    base, home = str(tmp_path / "t"), str(tmp_path / "home")

    def days_written():
        update_days(spark, base, home).settle()
        seen = {p.name: max(f.stat().st_mtime_ns for f in p.iterdir()) for p in (tmp_path / "home/driver_days").glob("date=*")}
        return seen

    def agrees():
        got = combine_features(update_days(spark, base, home).days, WEDNESDAY)
        return rows(got) == rows(training.driver_features(telemetry(spark, base), WEDNESDAY))

    for i in range(5):
        write_part(tables, base, f"date < '2024-01-06' and event_id % 5 = {i}")
    first = days_written()
    assert len(first) == 5 and agrees() and days_written() == first
    write_part(tables, base, "date = '2024-01-08'")
    write_part(tables, base, "date = '2024-01-03' and event_id % 2 = 0")
    second = days_written()
    assert {d for d in second if second[d] != first.get(d)} == {"date=2024-01-03", "date=2024-01-08"} and agrees()
    compaction.compact(spark, base, ["2024-01-02"], dry_run=False)
    shutil.rmtree(f"{base}/date=2024-01-01")
    third = days_written()
    assert "date=2024-01-01" not in third and third["date=2024-01-02"] != second["date=2024-01-02"] and agrees()
