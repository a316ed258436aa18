"""Per-day driver partials, recomputed only for days whose files changed.

A full refresh reads all telemetry, which at scale means reading years of files to learn
about one new day. Here each date folder is reduced to one partial per driver and kept.
A refresh lists the folders, recomputes the days whose files differ from the last run, and
merges the days of the months they lie in; the features are merged from one partial per
driver and month and equal those computed from all telemetry.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.mergeable import PARTIAL, merge_partials, partial_features
from ..schemas import struct
from ..sources import overwrite_atomically, recover_swap, telemetry
from ..sources.paths import Files, or_empty
from ..sources.telemetry import TELEMETRY_FILES, skipped_files

STATE = struct("date DATE, files BIGINT, bytes BIGINT, newest TIMESTAMP")
DAYS = StructType([*struct("driver_id BIGINT").fields, *PARTIAL.fields, *struct("date DATE").fields])
MONTHS = StructType([*struct("driver_id BIGINT").fields, *PARTIAL.fields, *struct("month STRING").fields])


def folder_state(spark: SparkSession, base: str) -> DataFrame:
    """Number, size and newest change of the telemetry files of each date."""
    def read() -> DataFrame:
        return (
            spark.read.format("binaryFile").option("pathGlobFilter", TELEMETRY_FILES)
            .option("recursiveFileLookup", "true").load(base)
            .groupBy(F.regexp_extract("path", r"/date=([^/]+)/", 1).try_cast("date").alias("date"))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
                 F.max("modificationTime").alias("newest"))
            .where(F.col("date").isNotNull())
        )

    return or_empty(spark, STATE, read)


@dataclass(frozen=True)
class DayUpdate:
    """The partials of all days and months, which days this update recomputed or dropped, and
    which months it merged again. ``skipped`` lists damaged files of the changed days: none of
    their rows count."""

    days: DataFrame
    months: DataFrame
    changed: list
    gone: list
    merged: list
    skipped: DataFrame | None
    _settle: Callable[[], None]

    def settle(self) -> None:
        """Remember the folders as they were listed. Until then the same days count as changed,
        so that work that stops before its results are stored is done again."""
        self._settle()


def update_days(spark: SparkSession, base: str, home: str) -> DayUpdate:
    """Bring the partials under ``home`` up to date with ``base``; see :meth:`DayUpdate.settle`."""
    state, days = f"{home}/folder_state", f"{home}/driver_days"
    recover_swap(spark, state)
    # One row per date, so both lists are bounded by the calendar. The listing is taken
    # once: a file that arrives later makes its day differ at the next run.
    now = {tuple(r) for r in folder_state(spark, base).collect()}
    then = {tuple(r) for r in or_empty(
        spark, STATE, lambda: spark.read.schema(STATE).parquet(state)).collect()}
    changed = sorted({day for day, *_ in now - then})
    gone = sorted({day for day, *_ in then} - {day for day, *_ in now})

    files = Files(spark, home)
    for day in changed + gone:
        files.delete(f"{days}/date={day}", recursive=True)
    skipped = None
    if changed:
        # Only the changed folders are listed and read. A file that is damaged anywhere is left out whole.
        listed = list(map(str, changed))
        skipped = overwrite_atomically(skipped_files(spark, base, dates=listed), f"{home}/skipped_files")
        fresh = telemetry(spark, base, skip_corrupt=True, dates=listed, without=skipped)
        # Rebalanced by date: one file per small day, several for a large one.
        partial_features(fresh, "date").select(*DAYS.names).hint("rebalance", "date") \
            .write.mode("append").partitionBy("date").parquet(days)

    def settle() -> None:
        if changed or gone:
            overwrite_atomically(spark.createDataFrame(sorted(now), STATE), state)

    partials = or_empty(spark, DAYS, lambda: spark.read.schema(DAYS).parquet(days))
    months, merged = _update_months(spark, partials, home, {day for day, *_ in now}, changed + gone)
    return DayUpdate(partials, months, changed, gone, merged, skipped, settle)


def _update_months(spark: SparkSession, days: DataFrame, home: str, present: set, touched: list) -> tuple[DataFrame, list]:
    """Merge the days of each month with a touched day (or without a partial yet) to one partial
    per driver; the other months stay as they are."""
    path, files = f"{home}/driver_months", Files(spark, home)
    kept = {name[6:] for name, _ in files.states(path) if name.startswith("month=")}
    wanted = {f"{day:%Y-%m}" for day in present}
    again = sorted({f"{day:%Y-%m}" for day in touched} | (wanted - kept))
    for month in again:
        files.delete(f"{path}/month={month}", recursive=True)
    todo = [month for month in again if month in wanted]
    if todo:
        # Ranges of the partition column: other months' folders are not read.
        ranges = [F.col("date").between(F.lit(f"{m}-01").cast("date"), F.last_day(F.lit(f"{m}-01").cast("date"))) for m in todo]
        inside = ranges[0]
        for more in ranges[1:]:
            inside = inside | more
        month = F.date_format("date", "yyyy-MM").alias("month")
        merge_partials(days.where(inside).select("driver_id", *PARTIAL.names, month), "driver_id", "month") \
            .select(*MONTHS.names).hint("rebalance", "month").write.mode("append").partitionBy("month").parquet(path)
    return or_empty(spark, MONTHS, lambda: spark.read.schema(MONTHS).parquet(path)), again
