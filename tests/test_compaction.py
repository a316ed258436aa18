import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roadledger.operators.inventory import list_files
from roadledger.operators.quality import fingerprint, rows_match
from roadledger.plans import compaction
from roadledger.sources import telemetry

DAY = "2024-01-15"


def write_small_files(spark, base, day=DAY, files=6, rows_each=200):
    """``files`` telemetry files of one date, each with its own rows."""
    for i in range(files):
        (
            spark.range(i * rows_each, (i + 1) * rows_each, numPartitions=1)
            .select(
                (F.col("id") % 7).alias("policy_id"), F.concat(F.lit("VIN"), F.col("id")).alias("vin"),
                (F.lit(1705276800) + F.col("id")).cast("string").alias("event_time"),
                (F.col("id") % 90).cast("double").alias("speed_mph"), (F.col("id") % 5).alias("driver_id"))
            .write.mode("append").option("mapreduce.output.basename", f"telemetry-{i}")
            .parquet(f"{base}/date={day}")
        )


def parquet_names(base, day=DAY):
    return sorted(n for n in os.listdir(f"{base}/date={day}") if n.endswith(".parquet"))


def statuses(result):
    return [(str(r["date"]), r["status"]) for r in result.collect()]


def test_merges_and_keeps_every_row(spark, tmp_path):
    base = str(tmp_path / "t")
    write_small_files(spark, base)
    before = rows(telemetry(spark, base))
    done = compaction.compact(spark, base, [DAY], dry_run=False).collect()
    assert [(r["status"], r["source_files"], r["written_files"], r["rows"]) for r in done] == [("COMPACTED", 6, 1, 1200)]
    names = parquet_names(base)
    assert len(names) == 1 and names[0].startswith("telemetry-consolidated-")
    assert rows(telemetry(spark, base)) == before
    assert os.listdir(f"{base}/_compaction") == []


def test_target_size_decides_the_number_of_files(spark, tmp_path):
    base = str(tmp_path / "t")
    write_small_files(spark, base, files=5, rows_each=200_000)
    size = sum(r["bytes"] for r in list_files(spark, base).collect())
    assert size > 3 << 20
    done = compaction.compact(spark, base, [DAY], target_mb=1, dry_run=False).first()
    assert done["status"] == "COMPACTED" and done["written_files"] >= 3
    assert telemetry(spark, base).count() == 1_000_000


def test_dry_run_and_minimum(spark, tmp_path):
    base = str(tmp_path / "t")
    write_small_files(spark, base)
    write_small_files(spark, base, day="2024-01-14", files=4)
    before = parquet_names(base)
    result = compaction.compact(spark, base, compaction.dates_back(DAY, 2))
    assert statuses(result) == [(DAY, "PLANNED"), ("2024-01-14", "SKIPPED"), ("2024-01-13", "SKIPPED")]
    assert parquet_names(base) == before
    done = compaction.compact(spark, base, [DAY, "2024-01-14"], dry_run=False)
    assert statuses(done) == [(DAY, "COMPACTED"), ("2024-01-14", "SKIPPED")]
    assert len(parquet_names(base, "2024-01-14")) == 4


def test_consolidated_files_are_left_alone(spark, tmp_path):
    base = str(tmp_path / "t")
    write_small_files(spark, base)
    compaction.compact(spark, base, [DAY], dry_run=False)
    first = parquet_names(base)
    write_small_files(spark, base, files=5)
    compaction.compact(spark, base, [DAY], dry_run=False)
    assert len(parquet_names(base)) == 2 and first[0] in parquet_names(base)
    assert telemetry(spark, base).count() == 2200


def test_unreadable_source_leaves_everything_in_place(spark, tmp_path):
    base = str(tmp_path / "t")
    write_small_files(spark, base)
    write_small_files(spark, base, day="2024-01-14")
    with open(f"{base}/date={DAY}/telemetry-bad.parquet", "wb") as bad:
        bad.write(b"x" * 5000)
    before = parquet_names(base)
    result = compaction.compact(spark, base, [DAY, "2024-01-14"], dry_run=False)
    assert statuses(result) == [(DAY, "FAILED"), ("2024-01-14", "COMPACTED")]
    assert not compaction.succeeded(result)
    assert parquet_names(base) == before
    assert telemetry(spark, base, skip_corrupt=True).count() == 2400


def test_type_drift_needs_a_schema(spark, tmp_path):
    from roadledger.schemas import TELEMETRY_FILE

    base = str(tmp_path / "t")
    write_small_files(spark, base, files=5)
    drift = spark.range(500).select(F.col("id").alias("policy_id"), F.lit(82).alias("device_battery_level"))
    real = spark.range(500).select(F.col("id").alias("policy_id"), F.lit(82.5).alias("device_battery_level"))
    for df in (drift, real):
        df.coalesce(1).write.mode("append").option("mapreduce.output.basename", "telemetry-d").parquet(f"{base}/date={DAY}")
    assert compaction.compact(spark, base, [DAY], dry_run=False).first()["status"] == "FAILED"
    done = compaction.compact(spark, base, [DAY], dry_run=False, schema=TELEMETRY_FILE).first()
    assert (done["status"], done["rows"]) == ("COMPACTED", 2000), done["detail"]
    assert rows(telemetry(spark, base).where("device_battery_level is not null")
                .groupBy("device_battery_level").count()) == [(82.0, 500), (82.5, 500)]


def test_thirty_dates_are_one_write(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "t")
    days = [f"2024-01-{d:02d}" for d in range(1, 31)]
    spark.range(30 * 5 * 200, numPartitions=5).select(
        F.col("id").alias("policy_id"), F.concat(F.lit("VIN"), F.col("id")).alias("vin"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("date"),
    ).write.partitionBy("date").option("mapreduce.output.basename", "telemetry").parquet(base)
    before = rows(telemetry(spark, base).select("date", "policy_id", "vin"))
    jobs = []
    merge = compaction._merge
    monkeypatch.setattr(compaction, "_merge", lambda *a: (jobs.append(a[3]), merge(*a))[1])
    done = compaction.compact(spark, base, days, dry_run=False).collect()
    assert jobs == [days]
    assert {(str(r["date"]), r["status"], r["source_files"], r["written_files"], r["rows"]) for r in done} == {
        (day, "COMPACTED", 5, 1, 1000) for day in days}
    assert rows(telemetry(spark, base).select("date", "policy_id", "vin")) == before


def moment(spark, base):
    return rows(telemetry(spark, base).groupBy("date", "driver_id").count())


@pytest.mark.parametrize("stop", ["written", "marked", "half moved", "moved", "committed", "half deleted"])
def test_readers_see_each_row_once_whenever_a_run_stops(spark, tmp_path, monkeypatch, stop):
    """A run that dies at each step: scans then, and after the next run has cleaned up."""
    base = str(tmp_path / "t")
    write_small_files(spark, base)
    write_small_files(spark, base, day="2024-01-14")
    before, expected = moment(spark, base), telemetry(spark, base).count()

    class Stop(BaseException):
        pass

    def stop_now(*_):
        raise Stop

    def after(original, calls):
        def act(self, *args, **kw):
            result = original(self, *args, **kw)
            calls[0] -= 1
            if calls[0] == 0:
                raise Stop
            return result
        return act

    with monkeypatch.context() as patch:
        if stop == "written":
            patch.setattr(compaction, "write_text", stop_now)
        elif stop == "marked":
            patch.setattr(compaction, "_in_batches", stop_now)
        elif stop == "half moved":
            patch.setattr(compaction.Files, "rename", after(compaction.Files.rename, [1]))
        elif stop == "moved":
            rename = compaction.Files.rename
            patch.setattr(compaction.Files, "rename",
                          lambda self, old, new: stop_now() if new.endswith(".committed") else rename(self, old, new))
        elif stop == "committed":
            patch.setattr(compaction, "_finish", stop_now)
        else:
            patch.setattr(compaction.Files, "delete", after(compaction.Files.delete, [3]))
        with pytest.raises(Stop):
            compaction.compact(spark, base, [DAY, "2024-01-14"], dry_run=False)
    assert moment(spark, base) == before
    compaction.recover(spark, base)
    assert moment(spark, base) == before and os.listdir(f"{base}/_compaction") == []
    assert len(parquet_names(base)) == (1 if stop in ("committed", "half deleted") else 6)
    compaction.compact(spark, base, [DAY, "2024-01-14"], dry_run=False)
    assert moment(spark, base) == before and telemetry(spark, base).count() == expected
    assert len(parquet_names(base)) == 1


def test_a_scan_planned_before_the_commit_still_runs(spark, tmp_path):
    base = str(tmp_path / "t")
    write_small_files(spark, base)
    planned = telemetry(spark, base)
    compaction.compact(spark, base, [DAY], dry_run=False, keep_sources=True)
    assert len(parquet_names(base)) == 7
    assert planned.count() == telemetry(spark, base).count() == 1200
    assert telemetry(spark, base).where("date = '2024-01-15'").count() == 1200
    assert compaction.recover(spark, base) == 1
    assert len(parquet_names(base)) == 1 and telemetry(spark, base).count() == 1200


def test_session_settings_do_not_leak(spark, tmp_path):
    base = str(tmp_path / "t")
    write_small_files(spark, base)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    compaction.compact(spark, base, [DAY], target_mb=7, dry_run=False)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_tiny_files(spark, tmp_path):
    base = str(tmp_path / "t")
    write_small_files(spark, base)
    folder = f"{base}/date={DAY}"
    for name, size in (("telemetry-a.parquet", 1024), ("telemetry-b.parquet", 0), ("telemetry-c.parquet", 1025)):
        with open(f"{folder}/{name}", "wb") as f:
            f.write(b"x" * size)
    assert compaction.remove_tiny(spark, base) == 2
    assert "telemetry-a.parquet" in parquet_names(base)
    assert compaction.remove_tiny(spark, base, dry_run=False) == 2
    assert "telemetry-a.parquet" not in parquet_names(base) and "telemetry-c.parquet" in parquet_names(base)


def test_small_files_with_rows_are_not_tiny_junk(spark, tmp_path):
    base = str(tmp_path / "t")
    spark.range(3, numPartitions=1).select(F.col("id").alias("a")).write.option("compression", "snappy") \
        .option("mapreduce.output.basename", "telemetry").parquet(f"{base}/date={DAY}")
    size = list_files(spark, base).first()["bytes"]
    with open(f"{base}/date={DAY}/telemetry-junk.parquet", "wb") as f:
        f.write(b"x" * size)
    assert compaction.remove_tiny(spark, base, tiny_bytes=size, dry_run=False) == 1
    assert len(parquet_names(base)) == 1 and "junk" not in parquet_names(base)[0]


def test_only_changed_folders_are_listed_again(spark, tmp_path, monkeypatch):
    from roadledger.operators import inventory

    base, saved = str(tmp_path / "t"), str(tmp_path / "saved")
    for d in range(1, 31):
        os.makedirs(f"{base}/date=2024-01-{d:02d}")
        for k in range(d % 3):
            with open(f"{base}/date=2024-01-{d:02d}/telemetry-{k}.parquet", "wb") as f:
                f.write(b"x" * (k * 10))  # the first one is empty
    first = inventory.refreshed_listing(spark, base, saved, settle_ms=0)
    assert len(first.relisted) == 30

    def counts(listing):
        return [(r["date"].day, r["files"], r["bytes"]) for r in listing.inventory.orderBy("date").collect()]

    assert counts(first) == [(d, d % 3, 10 if d % 3 == 2 else 0) for d in range(1, 31)]
    with monkeypatch.context() as patch:
        patch.setattr(inventory, "list_files", None)  # unchanged folders need no listing
        again = inventory.refreshed_listing(spark, base, saved, settle_ms=0)
    assert again.relisted == again.gone == [] and counts(again) == counts(first)
    with open(f"{base}/date=2024-01-03/telemetry-new.parquet", "wb") as f:
        f.write(b"x" * 7)
    os.remove(f"{base}/date=2024-01-02/telemetry-1.parquet")
    os.rename(f"{base}/date=2024-01-30", f"{base}/date=2024-02-01")
    later = inventory.refreshed_listing(spark, base, saved, settle_ms=0)
    assert later.relisted == ["2024-01-02", "2024-01-03", "2024-02-01"] and later.gone == ["2024-01-30"]
    assert counts(later)[:3] == [(1, 1, 0), (2, 1, 0), (3, 1, 7)] and len(counts(later)) == 30


def test_a_folder_changed_just_now_is_listed_again(spark, tmp_path):
    from roadledger.operators import inventory

    base, saved = str(tmp_path / "t"), str(tmp_path / "saved")
    os.makedirs(f"{base}/date={DAY}")
    assert inventory.refreshed_listing(spark, base, saved, settle_ms=10**9).relisted == [DAY]
    assert inventory.refreshed_listing(spark, base, saved, settle_ms=10**9).relisted == [DAY]
    assert inventory.refreshed_listing(spark, base, saved, settle_ms=0).relisted == [DAY]
    assert inventory.refreshed_listing(spark, base, saved, settle_ms=0).relisted == []


def test_row_check_sees_a_changed_value(spark):
    a = spark.range(100).select("id", (F.col("id") * 2).alias("v"))
    b = a.withColumn("v", F.when(F.col("id") == 7, 0).otherwise(F.col("v")))
    assert rows_match(a, a.repartition(3)).first()["matches"]
    got = rows_match(a, b).first()
    assert got["rows_before"] == got["rows_after"] == 100 and not got["matches"]
    assert fingerprint(a).first()["rows"] == 100
    by_id = rows_match(a, b.where("id < 50"), "id")
    assert by_id.where("not matches").count() == 51


def test_snapshot_compares_only_unfiltered_runs(spark, tmp_path):
    from roadledger.operators.inventory import inventory_diff

    base, saved = str(tmp_path / "t"), str(tmp_path / "saved")
    write_small_files(spark, base, files=2)
    current, previous = compaction.snapshot(spark, base, saved)
    assert previous is None and [(str(d), n) for d, n, _ in rows(current)] == [(DAY, 2)]
    write_small_files(spark, base, files=1)
    write_small_files(spark, base, day="2024-01-16", files=1)
    assert compaction.snapshot(spark, base, saved, prefix="2024-02")[0].count() == 0
    current, previous = compaction.snapshot(spark, base, saved)
    assert [(str(r[0]), *r[1:]) for r in rows(inventory_diff(current, previous))] == [
        (DAY, 3, 2, 1, "kept"), ("2024-01-16", 1, 0, 1, "added")]
