"""Small-file compaction of date partitions, all dates of a range in one job.

Each date is one branch of a union over a single scan, read with splits of the target size:
the scan packs the files of a date, longest first, into tasks of about ``target_mb``, and
each task writes one file, so merging needs neither a shuffle nor a job per date. The merged
files are read back and must agree with the sources by rows and checksum per date. Then they
go to the date folders, hidden from scans by the run's marker until one rename makes them
count instead of the sources (:mod:`..sources.manifest`).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date as Date
from datetime import timedelta
from functools import reduce
from itertools import islice

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.inventory import (
    CONSOLIDATED,
    compaction_preview,
    list_files,
    partition_inventory,
    refreshed_listing,
)
from ..operators.quality import rows_match
from ..schemas import struct
from ..sources.manifest import COMMITTED, PENDING, WORK, merged_by, runs
from ..sources.paths import Files, or_empty, write_text
from ..sources.telemetry import TELEMETRY_FILES
from ..sources.writers import TELEMETRY_WRITE_OPTIONS

TINY_BYTES = 1024
MIN_FILES = 5
TARGET_MB = 128
# Threads that move or delete files, and files handed to one at a time.
MOVERS, MOVE_BATCH = 16, 500

RESULT = struct(
    "date DATE, status STRING, source_files BIGINT, source_bytes BIGINT, "
    "written_files BIGINT, rows BIGINT, detail STRING"
)


def dates_back(day: str | Date, days_back: int = 0) -> list[str]:
    """``day`` and the ``days_back`` days before it, newest first."""
    start = Date.fromisoformat(str(day))
    return [(start - timedelta(days=i)).isoformat() for i in range(days_back + 1)]


def sources_of(files: DataFrame, tiny_bytes: int = TINY_BYTES) -> DataFrame:
    """Listed files that compaction may merge: not merged before and not tiny."""
    return files.where(~F.col("name").contains(CONSOLIDATED) & (F.col("bytes") > tiny_bytes))


def compact(
    spark: SparkSession,
    base: str,
    dates: list[str],
    *,
    target_mb: int = TARGET_MB,
    min_files: int = MIN_FILES,
    dry_run: bool = True,
    schema: StructType | None = None,
    delete_tiny: bool = False,
    keep_sources: bool = False,
) -> DataFrame:
    """Merge the small files of all ``dates`` in one job; one result row per date.

    A dry run lists and sizes only. Dates with fewer than ``min_files`` source files are
    skipped. If the job fails, it is tried on each half of its dates, so that a date that
    cannot be merged ends up alone: it is reported as FAILED, its sources untouched, and the
    others are merged. Files that arrive meanwhile are not part of the scan and stay.
    ``schema`` fixes the column types when writers of a date disagree about them.

    ``keep_sources`` leaves the merged sources in place, hidden from scans, until the next
    compaction or :func:`recover`: scans that were planned before then still find them.
    One compaction may run on a folder at a time.
    """
    if not dry_run:
        recover(spark, base)
        if delete_tiny:
            remove_tiny(spark, base, dry_run=False, dates=dates)
    listed = sources_of(list_files(spark, base, pattern=TELEMETRY_FILES, dates=dates))
    sizes = {str(r["date"]): (r["files"], r["bytes"]) for r in partition_inventory(listed).collect()}
    eligible = [d for d in dates if sizes.get(d, (0, 0))[0] >= min_files]
    done = {} if dry_run else _compact_dates(spark, base, eligible, target_mb, schema, keep_sources)
    results = []
    for day in dates:
        n, size = sizes.get(day, (0, 0))
        status, written, rows, detail = done.get(day) or (
            ("SKIPPED", 0, None, f"fewer than {min_files} files") if day not in eligible
            else ("PLANNED", -(-size // (target_mb << 20)), None, "dry run"))
        results.append((Date.fromisoformat(day), status, n, size, written, rows, detail))
    return spark.createDataFrame(results, RESULT)


def _compact_dates(spark, base, dates, target_mb, schema, keep_sources) -> dict[str, tuple]:
    """Per date (status, files written, rows, detail)."""
    if not dates:
        return {}
    run = uuid.uuid4().hex
    try:
        done = _merge(spark, base, run, dates, target_mb, schema)
    except Exception as error:  # whatever failed, nothing counts yet: put all as it was
        _undo(spark, base, run)
        if len(dates) == 1:
            return {dates[0]: ("FAILED", 0, None, " ".join(str(error).split())[:500])}
        half = len(dates) // 2
        return {day: result for part in (dates[:half], dates[half:])
                for day, result in _compact_dates(spark, base, part, target_mb, schema, keep_sources).items()}
    if not keep_sources:
        _finish(spark, base, run)
    return done


def _merge(spark, base: str, run: str, dates: list[str], target_mb: int, schema) -> dict[str, tuple]:
    """Write, check and commit the merged files of ``dates``."""
    # A session of its own keeps the split settings from leaking into the caller's.
    own = spark.newSession()
    for key, value in {
        "files.maxPartitionBytes": target_mb << 20, "files.openCostInBytes": 0, "files.minPartitionNum": 1,
        "files.ignoreCorruptFiles": "false", "files.ignoreMissingFiles": "false",
        "sources.partitionColumnTypeInference.enabled": "false",
    }.items():
        own.conf.set(f"spark.sql.{key}", str(value))
    files, work = Files(spark, base), f"{base}/{WORK}"

    def read(place: str, pattern: str) -> DataFrame:
        reader = own.read.option("basePath", place).option("pathGlobFilter", pattern)
        if schema is not None:
            reader = reader.schema(StructType([f for f in schema.fields if f.name != "date"]).add("date", "string"))
        else:
            reader = reader.option("mergeSchema", "true")
        return reader.parquet(*[f"{place}/date={day}" for day in dates])

    # Conditions on file metadata: files are left out before they are opened.
    source = read(base, TELEMETRY_FILES).where(
        ~F.col("_metadata.file_name").contains(CONSOLIDATED) & (F.col("_metadata.file_size") > TINY_BYTES))
    columns = [c for c in source.columns if c != "date"]
    # Needs no column, so only footers are read: an independent count of every source file.
    source.groupBy("date", F.col("_metadata.file_name").alias("name")).agg(F.count(F.lit(1)).alias("rows")) \
        .select(F.col("date").cast("date").alias("date"), "name", "rows").write.parquet(f"{work}/{run}/merged")
    counted = {str(r["date"]): r["rows"] for r in merged_by(own, base, run).groupBy("date").agg(
        F.sum("rows").alias("rows")).collect()}
    dates = [day for day in dates if counted.get(day)]
    staged = f"{work}/{run}/data"
    branches = [source.where(F.col("date") == day).select(*columns, "date") for day in dates]
    if branches:
        (
            reduce(DataFrame.unionAll, branches).write.partitionBy("date").options(**TELEMETRY_WRITE_OPTIONS)
            .option("mapreduce.output.basename", f"telemetry-{CONSOLIDATED}-{run}").parquet(staged)
        )
        _check(source.select(*columns, "date"), read(staged, "*.parquet").select(*columns, "date"), counted)
    moved = files.folders(f"{staged}/date=*/*.parquet")
    write_text(spark, f"{work}/{run}{PENDING}", "")
    place = {path: f"{base}/{'/'.join(path.split('/')[-2:])}" for path in moved}
    _in_batches(spark, moved, lambda path: files.rename(path, place[path]))
    files.rename(f"{work}/{run}{PENDING}", f"{work}/{run}{COMMITTED}")
    return {day: ("COMPACTED", sum(f"/date={day}/" in path for path in moved), n, None) for day, n in counted.items()}


def _check(source: DataFrame, merged: DataFrame, counted: dict[str, int]) -> None:
    """One grouped aggregate over both sides; reading the merged files covers every stored byte."""
    found = {r["date"]: r for r in rows_match(source, merged, "date").collect()}
    for day, rows in counted.items():
        both = found.get(day)
        if not both or not rows == both["rows_before"] == both["rows_after"]:
            raise RuntimeError(f"{day}: rows differ, {rows} in footers, {both}")
        if not both["matches"]:
            raise RuntimeError(f"{day}: checksums of source and merged rows differ")


def _undo(spark, base: str, run: str) -> None:
    """Remove what a run that was not committed has written."""
    files, work = Files(spark, base), f"{base}/{WORK}"
    if files.exists(f"{work}/{run}{PENDING}"):
        found = files.folders(f"{base}/date=*/telemetry-{CONSOLIDATED}-{run}*")
        delete_files(spark, base, found)
    files.delete(f"{work}/{run}", recursive=True)
    files.delete(f"{work}/{run}{PENDING}")


def _finish(spark, base: str, run: str) -> None:
    """Delete the sources of a committed run, then its list and marker."""
    files, work = Files(spark, base), f"{base}/{WORK}"
    if files.exists(f"{work}/{run}/merged"):
        rows = merged_by(spark, base, run).toLocalIterator(prefetchPartitions=True)
        delete_files(spark, base, (f"{base}/date={r['date']}/{r['name']}" for r in rows))
    # The marker goes before the list: no scan may look for a list that is gone.
    files.delete(f"{work}/{run}{COMMITTED}")
    files.delete(f"{work}/{run}", recursive=True)


def recover(spark: SparkSession, base: str) -> int:
    """End runs that were interrupted or kept their sources: committed ones are finished, others
    undone. Returns how many."""
    found = runs(spark, base)
    for run, state in found.items():
        (_undo if state == PENDING else _finish)(spark, base, run)
    work, files = f"{base}/{WORK}", Files(spark, base)
    if files.exists(work):  # lists whose run has no marker (yet)
        for name in files.names(work):
            files.delete(f"{work}/{name}", recursive=True)
    return len(found)


def delete_files(spark: SparkSession, root: str, paths: Iterable[str]) -> int:
    """Delete files, several batches at a time; returns how many were there."""
    files = Files(spark, root)
    return _in_batches(spark, paths, files.delete)


def _in_batches(spark: SparkSession, paths: Iterable[str], do: Callable[[str], object]) -> int:
    """``do`` for each path by a few threads; returns how often it gave something true.

    Paths are taken from the iterator as threads get free, so the driver holds no more than the
    batches under way.
    """
    paths = iter(paths)

    def each(batch: list[str]) -> int:
        return sum(bool(do(path)) for path in batch)

    total, waiting = 0, []
    with ThreadPoolExecutor(MOVERS) as pool:
        while batch := list(islice(paths, MOVE_BATCH)):
            waiting.append(pool.submit(inheritable_thread_target(spark)(each), batch))
            if len(waiting) >= 2 * MOVERS:
                total += waiting.pop(0).result()
        return total + sum(w.result() for w in waiting)


def succeeded(result: DataFrame) -> bool:
    """Whether no date failed."""
    return result.where(F.col("status") == "FAILED").isEmpty()


def preview(spark: SparkSession, base: str, day: str | None = None, target_mb: int = TARGET_MB,
            min_files: int = MIN_FILES) -> DataFrame:
    """Sizes and expected gain of compaction, for one date or for all."""
    files = list_files(spark, base, pattern=TELEMETRY_FILES, dates=[day] if day else None)
    return compaction_preview(files, target_mb, min_files)


def remove_tiny(
    spark: SparkSession,
    base: str,
    *,
    tiny_bytes: int = TINY_BYTES,
    dry_run: bool = True,
    pattern: str = TELEMETRY_FILES,
    dates: list[str] | None = None,
) -> int:
    """Delete files of at most ``tiny_bytes`` that hold no rows; returns how many (would be) deleted.

    A small file whose footer can be read and counts rows is data, and stays. The listing is
    reduced to the victims on the executors and deleted in batches.
    """
    tiny = list_files(spark, base, pattern=pattern, dates=dates).where(F.col("bytes") <= tiny_bytes)
    place = r"([^/]+/[^/]+)$"
    held = or_empty(spark, struct("_place STRING"), lambda: (
        spark.read.schema("_none INT").option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern).parquet(base)
        .where(F.col("_metadata.file_size") <= tiny_bytes)
        .select(F.regexp_extract("_metadata.file_path", place, 1).alias("_place")).distinct()))
    victims = tiny.withColumn("_place", F.regexp_extract("path", place, 1)).join(held, "_place", "left_anti")
    if dry_run:
        return victims.count()
    return delete_files(spark, base, (r["path"] for r in victims.select("path").toLocalIterator()))


def snapshot(spark: SparkSession, base: str, saved: str, prefix: str | None = None):
    """File counts per date, with the difference to the last saved snapshot.

    Returns ``(inventory, previous)``. Only an unfiltered run is saved and compared; with
    a ``YYYY`` or ``YYYY-MM`` prefix ``previous`` is None. The listing behind it is kept, too:
    only folders that changed since the last run are listed again.
    """
    from ..sources.writers import overwrite_atomically

    inventory = refreshed_listing(spark, base, f"{saved}/listing").inventory
    if prefix:
        return inventory.where(F.col("date").cast("string").startswith(prefix)), None
    previous = None
    files = Files(spark, saved)
    if files.exists(f"{saved}/current"):
        kept = spark.read.schema(inventory.schema).parquet(f"{saved}/current")
        previous = overwrite_atomically(kept, f"{saved}/previous")
    current = overwrite_atomically(inventory, f"{saved}/current")
    return current, previous
