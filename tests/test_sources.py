import json
import os
from datetime import date, datetime
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from roadledger import sources
from roadledger.functions import instant
from roadledger.operators.inventory import list_files
from roadledger.plans.compaction import TELEMETRY_FILES
from roadledger.schemas import CORE, CRASH, TELEMETRY, TELEMETRY_FILE
from roadledger.sources.paths import Files

EVENT = {
    "policy_id": 71, "vehicle_id": 905, "vin": "ROADLEDGERTEST001",
    "event_time": "2023-07-02T05:06:07.250Z", "speed_mph": 51.25, "speed_limit_mph": 45,
    "current_street": "Quarry Lane", "g_force": 0.64, "driver_id": "DRIVER-12",
    "sensors": {
        "gps": {"latitude": 47.5, "longitude": 8.25, "altitude": 402.0, "speed_ms": 22.75, "bearing": 311.5,
                "accuracy": 5.5, "satellite_count": 7, "gps_fix_time": 90},
        "accelerometer": {"x": -0.5, "y": 0.25, "z": 1.5}, "gyroscope": {"pitch": 0.5, "roll": 0.125, "yaw": -0.75},
        "magnetometer": {"x": 12.5, "y": 3.5, "z": -20.25, "heading": 310.75}, "barometric_pressure": 966.5,
        "device": {"battery_level": 37.5, "signal_strength": -90, "orientation": "landscape",
                   "screen_on": True, "charging": False}},
}


@pytest.fixture
def stored(spark, tmp_path, telemetry_of):
    base = str(tmp_path / "telemetry")
    tel = telemetry_of(
        {"event_ts": "2024-01-15 08:00:00", "event_time": "1.7053056E9", "driver_id": 1},
        {"event_ts": "2024-01-15 09:00:00", "event_time": "1705309200000", "driver_id": 2},
        {"event_ts": "2024-01-16 10:00:00", "event_time": "2024-01-16T10:00:00Z", "driver_id": 3},
        policy_id=7, vin="V", speed_mph=10.0)
    sources.write_telemetry(tel, base)
    return base


def test_scan_decodes_time_and_finds_dates(spark, stored):
    tel = sources.telemetry(spark, stored)
    assert tel.columns == TELEMETRY.names
    assert rows(tel.select("driver_id", F.col("event_ts").cast("string"), "date")) == [
        (1, "2024-01-15 08:00:00", date(2024, 1, 15)), (2, "2024-01-15 09:00:00", date(2024, 1, 15)),
        (3, "2024-01-16 10:00:00", date(2024, 1, 16))]
    assert sources.telemetry(spark, stored, date_glob="2024-01-16").count() == 1
    # Reading must not change the shared schema.
    assert "date" not in TELEMETRY_FILE.names


def test_date_predicate_prunes_folders_and_columns(spark, stored):
    plan = sources.telemetry(spark, stored).where(F.col("date") == "2024-01-16").where("g_force > 1.5") \
        .select("driver_id")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(date" in scan and "GreaterThan(g_force,1.5)" in scan
    assert "ReadSchema: struct<g_force:double,driver_id:bigint>" in scan


def test_missing_paths_give_no_rows(spark, tmp_path):
    nowhere = str(tmp_path / "nowhere")
    assert sources.telemetry(spark, nowhere).schema == TELEMETRY
    assert sources.telemetry(spark, nowhere).count() == 0
    assert sources.telemetry_v1(spark, nowhere).count() == 0
    assert sources.crash_reports(spark, nowhere).count() == 0
    assert sources.load_core(spark, nowhere)["claims"].schema == CORE["claims"]
    assert sources.read_scores(spark, nowhere).count() == 0
    assert list_files(spark, nowhere).count() == 0


def test_writer_names_compression_and_row_groups(spark, tmp_path, telemetry_of):
    base = str(tmp_path / "t")
    tel = telemetry_of({"event_ts": "2024-01-15 08:00:00", "policy_id": 1})
    many = tel.crossJoin(spark.range(120_000)).withColumn("policy_id", F.col("id")).drop("id").coalesce(1)
    sources.write_telemetry(many, base)
    (name,) = [n for n in os.listdir(f"{base}/date=2024-01-15") if n.endswith(".parquet")]
    assert name.startswith("telemetry-")
    meta = pq.ParquetFile(f"{base}/date=2024-01-15/{name}").metadata
    column = meta.row_group(0).column(0)
    assert column.compression == "SNAPPY"
    assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [50_000, 50_000, 20_000]
    sources.write_telemetry(many, base, max_rows_per_file=50_000)
    assert len([n for n in os.listdir(f"{base}/date=2024-01-15") if n.endswith(".parquet")]) == 4


def test_corrupt_and_tiny_files_are_skipped_and_reported(spark, stored):
    folder = f"{stored}/date=2024-01-15"
    for name, size in (("telemetry-bad.parquet", 3000), ("telemetry-tiny.parquet", 10), ("telemetry-zero.parquet", 0)):
        with open(f"{folder}/{name}", "wb") as f:
            f.write(b"x" * size)
    with pytest.raises(Exception):
        sources.telemetry(spark, stored).collect()
    assert sources.telemetry(spark, stored, skip_corrupt=True).count() == 3
    skipped = {(os.path.basename(r["path"]), r["reason"]) for r in sources.skipped_files(spark, stored).collect()}
    assert skipped == {(f"telemetry-{x}.parquet", "no readable footer") for x in ("bad", "tiny", "zero")}


def test_small_valid_files_are_read_and_damaged_ones_reported(spark, tmp_path, telemetry_of):
    base = str(tmp_path / "t")
    sources.write_telemetry(telemetry_of(*[
        {"event_ts": "2024-01-15 08:00:00", "event_time": "1705305600", "driver_id": i, "vin": f"V{i}"}
        for i in range(20_000)]), base)
    folder = tmp_path / "t" / "date=2024-01-15"
    # One row of one column: a valid file below 1 KB.
    table = pa.table({"driver_id": pa.array([7], pa.int64())})
    pq.write_table(table, folder / "telemetry-small.parquet")
    assert (folder / "telemetry-small.parquet").stat().st_size <= 1024
    assert sources.telemetry(spark, base, skip_corrupt=True).count() == 20_001
    assert sources.skipped_files(spark, base).count() == 0
    large = max(folder.glob("telemetry-*.parquet"), key=lambda p: p.stat().st_size)
    raw = bytearray(large.read_bytes())
    start = pq.ParquetFile(large).metadata.row_group(0).column(0).data_page_offset
    raw[start:start + 200] = b"\xff" * 200
    large.write_bytes(raw)
    crc = large.with_name(f".{large.name}.crc")
    if crc.exists():
        crc.unlink()
    lost = sources.skipped_files(spark, base).first()
    got = sources.telemetry(spark, base, skip_corrupt=True).agg(F.count_if(F.xxhash64("*") != 0)).first()[0]
    assert lost["reason"] == "damaged" and lost["rows_lost"] == 20_001 - got


def test_integer_files_read_under_wider_types(spark, tmp_path):
    base = str(tmp_path / "t")
    spark.createDataFrame([(35, 82, 400018, "1705305600")],
                          "speed_limit_mph int, device_battery_level int, driver_id int, event_time string") \
        .write.option("mapreduce.output.basename", "telemetry").parquet(f"{base}/date=2024-01-15")
    got = sources.telemetry(spark, base).select("speed_limit_mph", "device_battery_level", "driver_id").first()
    assert tuple(got) == (35.0, 82.0, 400018)


@pytest.mark.parametrize("folder, driver", [
    ("2024-01-15/400018", 400018), ("date=2024-01-15/driver_id=400018", 400018),
    ("policy_id=200018/year=2024/month=01/date=2024-01-15", None)])
def test_legacy_layouts(spark, tmp_path, folder, driver):
    base = str(tmp_path / "v1")
    spark.range(20).select(
        F.lit(200018).cast("bigint").alias("policy_id"), F.lit(33.0).alias("speed_limit_mph"),
        instant("2024-01-15 10:30:45").alias("event_time"), F.lit(400018).alias("driver_id"),
    ).coalesce(1).write.option("mapreduce.output.basename", "telemetry").parquet(f"{base}/{folder}")
    tel = sources.telemetry_v1(spark, base)
    assert tel.columns == [*TELEMETRY.names, "driver_id_partition"]
    got = tel.select("policy_id", F.col("event_ts").cast("string"), "date", "driver_id_partition").distinct().collect()
    assert [tuple(r) for r in got] == [(200018, "2024-01-15 10:30:45", date(2024, 1, 15), driver)]


def crash_row(spark):
    values = {f.name: None for f in CRASH}
    values |= {"report_id": "r1", "policy_id": "200018", "vin": "V", "risk_score": 91.0,
               "crash_timestamp": datetime(2024, 1, 15, 8), "crash_type": "SIDE", "emergency_recommended": True}
    return spark.createDataFrame([tuple(values.values())], CRASH)


@pytest.mark.parametrize("by_position", [False, True])
def test_crash_reports_bind_names_or_positions(spark, tmp_path, by_position):
    base = str(tmp_path / "c")
    stored = crash_row(spark).withColumnsRenamed(
        {"crash_timestamp": "accident_timestamp", "crash_type": "accident_type"})
    if by_position:
        stored = stored.toDF(*[f"c{i}" for i in range(len(CRASH))])
    stored.write.parquet(f"{base}/severity_level=HIGH/report_date=2024-01-15")
    crash = sources.crash_reports(spark, base, by_position=by_position)
    assert crash.columns == [*CRASH.names, "severity_level", "report_date"]
    assert tuple(crash.select("report_id", "crash_type", "risk_score", "severity_level", "report_date").first()) == (
        "r1", "SIDE", 91.0, "HIGH", date(2024, 1, 15))
    with pytest.raises(ValueError):
        sources.bind_by_position(crash, CRASH)


def test_nested_json_is_flattened(spark, tmp_path):
    (tmp_path / "events.json").write_text(json.dumps(EVENT) + "\n")
    for tel in (sources.telemetry_json(spark, str(tmp_path / "events.json")),
                sources.parse_telemetry(spark.createDataFrame([(json.dumps(EVENT),)], "value string"))):
        assert tel.columns == TELEMETRY.names
        got = tel.select("driver_id", F.col("event_ts").cast("string"), "date", "gps_speed", "gyroscope_x",
                         "gyroscope_z", "magnetometer_heading", "barometric_pressure", "device_signal_strength",
                         "device_charging").first()
        assert tuple(got) == (12, "2023-07-02 05:06:07.25", date(2023, 7, 2), 22.75, 0.5, -0.75, 310.75,
                              966.5, -90, False)


def test_core_tables_from_csv(spark, tmp_path):
    folder = tmp_path / "core"
    (folder / "claims").mkdir(parents=True)
    (folder / "claims" / "claims.csv").write_text(
        "claim_id,accident_id,claim_date,status,amount,description,created_at,updated_at\n"
        "600001,500001,2023-10-15,APPROVED,3250.50,Repairs,,\n")
    got = sources.load_core(spark, str(folder), "csv")["claims"].first()
    assert (got["claim_id"], got["amount"], got["claim_date"], got["created_at"]) == (
        600001, Decimal("3250.50"), date(2023, 10, 15), None)


def scored(spark, *pairs):
    return spark.createDataFrame([(d, Decimal(s) if s else None) for d, s in pairs],
                                 "driver_id bigint, safe_driver_score decimal(5,2)")


def test_history_appends_and_repeats_without_doubling(spark, tmp_path):
    path = str(tmp_path / "scores")
    for run, day, data in (("r1", "2024-01-15", scored(spark, (1, "90"), (2, None))),
                           ("r2", "2024-01-15", scored(spark, (1, "80"))),
                           ("r2", "2024-01-15", scored(spark, (1, "81")))):
        sources.append_scores(data, path, run, instant(day), F.lit("n"))
    assert rows(sources.read_scores(spark, path).select("score_id", "score", "run_id")) == [
        ("r1-1", Decimal("90.00"), "r1"), ("r2-1", Decimal("81.00"), "r2")]


def test_swap_may_read_itself_and_recovers(spark, tmp_path):
    path = str(tmp_path / "table")
    sources.overwrite_atomically(spark.range(3), path)
    again = sources.overwrite_atomically(spark.read.parquet(path).selectExpr("id + 10 as id"), path)
    assert rows(again) == [(10,), (11,), (12,)]
    with pytest.raises(Exception):
        sources.overwrite_atomically(spark.range(3).selectExpr("raise_error('no') as id"), path)
    assert rows(spark.read.parquet(path)) == [(10,), (11,), (12,)]
    files = Files(spark, path)
    files.rename(path, path + "__old")
    assert sources.recover_swap(spark, path) and rows(spark.read.parquet(path)) == [(10,), (11,), (12,)]
    assert not sources.recover_swap(spark, path)


def test_rename_never_nests(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    a.mkdir(), b.mkdir()
    with pytest.raises(FileExistsError):
        Files(spark, str(a)).rename(str(a), str(b))


def test_pattern_leaves_other_files_out(spark, stored):
    spark.range(5).write.mode("append").parquet(f"{stored}/date=2024-01-15")
    assert sources.telemetry(spark, stored).count() == 3
    assert list_files(spark, stored, pattern=TELEMETRY_FILES).count() == \
        len([n for d in os.listdir(stored) if d.startswith("date=") for n in os.listdir(f"{stored}/{d}")
             if n.startswith("telemetry-")])
