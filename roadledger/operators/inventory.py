"""File inventory of a partitioned folder and the reports made from it."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import struct
from ..sources.paths import Files, or_empty
from ..sources.writers import overwrite_atomically, recover_swap

FILE_LIST = struct("path STRING, name STRING, bytes BIGINT, date DATE")
CONSOLIDATED = "consolidated"


# File-system calls under way at once.
LISTERS = 16


def list_files(spark: SparkSession, base: str, *, pattern: str = "*.parquet",
               date_glob: str | None = None, dates: list[str] | None = None) -> DataFrame:
    """Path, name, size and partition date of every file under ``base``; no file is opened.

    ``dates`` or ``date_glob`` restricts the listing itself to those ``date=`` folders, which
    bounds what one listing holds. Folders are listed in parallel by Spark. Its listing leaves
    out files of zero length, so a folder with more files than were listed is searched for
    those, several folders at a time.
    """
    files = Files(spark, base)
    if dates is not None:
        there = {name for name, _ in files.states(base)}
        folders = [f"{base}/date={day}" for day in dates if f"date={day}" in there]
        places = folders
    else:
        folders = files.folders(f"{base}/date={date_glob or '*'}")
        if not folders and date_glob is None:
            folders = files.folders(base)
        places = [base if date_glob is None else f"{base}/date={date_glob}"]

    def described(paths: DataFrame) -> DataFrame:
        return paths.select(
            "path",
            F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
            "bytes",
            F.regexp_extract("path", r"/date=([^/]+)/", 1).try_cast("date").alias("date"),
        )

    def read() -> DataFrame:
        return described(
            spark.read.format("binaryFile")
            .option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
            .load(places)
            .select("path", F.col("length").alias("bytes"))
        )

    if not places:
        return spark.createDataFrame([], FILE_LIST)
    listed = or_empty(spark, FILE_LIST, read)
    inside = F.regexp_extract("path", r"(/date=[^/]+)/", 1)
    counted = {row["d"]: row["n"] for row in
               listed.groupBy(inside.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}

    def empty_in(folder: str) -> list[str]:
        day = "/" + folder.rstrip("/").rsplit("/", 1)[-1]
        if files.count(folder) > counted.get(day if day.startswith("/date=") else "", 0):
            return files.empty_files(folder, pattern)
        return []

    with ThreadPoolExecutor(LISTERS) as pool:
        found = pool.map(inheritable_thread_target(spark)(empty_in), folders)
        empty = [path for paths in found for path in paths]
    if not empty:
        return listed
    zero = spark.createDataFrame([(path, 0) for path in empty], "path STRING, bytes BIGINT")
    return listed.unionByName(described(zero))


# A folder that changed so shortly before it was listed may change again within the clock's step.
SETTLE_MS = 2000
_FOLDERS = struct("day STRING, changed BIGINT")
_KEPT = struct("path STRING, name STRING, bytes BIGINT, day STRING")


@dataclass(frozen=True)
class Listing:
    """A kept listing: its files, the files and bytes of each date folder (empty ones with 0), and
    which folders this refresh listed again or found gone."""

    files: DataFrame
    inventory: DataFrame
    relisted: list[str]
    gone: list[str]


def refreshed_listing(spark: SparkSession, base: str, saved: str, *, pattern: str = "*.parquet",
                      settle_ms: int = SETTLE_MS) -> Listing:
    """The listing of ``base`` kept at ``saved``, brought up to date.

    One call lists the date folders with their times of change. Only folders whose time differs
    from the kept one are listed again; the files of the others come from the kept table. The
    times are stored last: work that stops before that is done again by the next refresh.
    """
    place, times = Files(spark, saved), f"{saved}/folders"
    recover_swap(spark, times)
    clock = int(time.time() * 1000)
    now = {name[5:]: changed for name, changed in Files(spark, base).states(base) if name.startswith("date=")}
    then = {r["day"]: r["changed"] for r in or_empty(
        spark, _FOLDERS, lambda: spark.read.schema(_FOLDERS).parquet(times)).collect()}
    relisted = sorted(day for day, changed in now.items() if then.get(day) != changed)
    gone = sorted(set(then) - set(now))
    for day in relisted + gone:
        place.delete(f"{saved}/files/day={day}", recursive=True)
    if relisted:
        fresh = list_files(spark, base, pattern=pattern, dates=relisted)
        fresh.select("path", "name", "bytes", F.regexp_extract("path", r"/date=([^/]+)/", 1).alias("day")) \
            .hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(f"{saved}/files")
    if relisted or gone:
        known = [(day, changed if clock - changed > settle_ms else -1) for day, changed in sorted(now.items())]
        overwrite_atomically(spark.createDataFrame(known, _FOLDERS), times)
    kept = or_empty(spark, _KEPT, lambda: spark.read.schema(_KEPT).parquet(f"{saved}/files"))
    files = kept.select("path", "name", "bytes", F.col("day").try_cast("date").alias("date"))
    days = spark.createDataFrame([(day,) for day in sorted(now)], "day STRING").select(F.col("day").try_cast("date").alias("date"))
    inventory = days.where("date is not null").join(partition_inventory(files), "date", "left").select(
        "date", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("files", "bytes")])
    return Listing(files, inventory, relisted, gone)


def partition_inventory(files: DataFrame) -> DataFrame:
    """Files and bytes per date partition."""
    return files.where(F.col("date").isNotNull()).groupBy("date").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")
    )


def running_total(inventory: DataFrame) -> DataFrame:
    """Files per date with the running total over all dates.

    Dates are summed within their month and months are offset by the ones before them, so
    the only window over everything has one row per calendar month.
    """
    month = F.trunc("date", "month")
    monthly = inventory.groupBy(month.alias("_month")).agg(F.sum("files").alias("_n"))
    before = monthly.select("_month", F.coalesce(
        F.sum("_n").over(Window.orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    ).alias("_before"))
    within = Window.partitionBy("_month").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return (
        inventory.withColumn("_month", month).join(before, "_month")
        .select("date", "files", (F.sum("files").over(within) + F.col("_before")).alias("running_total"))
    )


def inventory_diff(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Files per date now and before, the difference, and whether the date is new or gone."""
    now = current.select("date", F.col("files").alias("files_now"))
    then = previous.select("date", F.col("files").alias("files_before"))
    return (
        now.join(then, "date", "full_outer")
        .withColumn("change", F.when(F.col("files_before").isNull(), "added")
                    .when(F.col("files_now").isNull(), "removed").otherwise("kept"))
        .fillna(0, ["files_now", "files_before"])
        .select("date", "files_now", "files_before",
                (F.col("files_now") - F.col("files_before")).alias("diff"), "change")
    )


def partitions_added(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Dates present now and not before."""
    return current.select("date").join(previous.select("date"), "date", "left_anti")


def partitions_removed(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Dates present before and not now."""
    return partitions_added(previous, current)


def _grade(files: Column, min_files: int) -> Column:
    """How worthwhile compaction of a date is, by its number of files."""
    return (
        F.when(files < min_files, "below minimum")
        .when(files > 10, "excellent")
        .when(files > 5, "good")
        .otherwise("eligible")
    )


def compaction_preview(files: DataFrame, target_mb: int = 128, min_files: int = 5,
                       round_up: bool = True) -> DataFrame:
    """What compaction would do per date: sizes, files afterwards, reduction and grade.

    ``round_up=False`` estimates the files afterwards with a floor, as the remote analysis
    does. Sizes and percentages are whole numbers.
    """
    target = target_mb * 1024 * 1024
    per_date = files.where(F.col("date").isNotNull()).groupBy("date").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("bytes").alias("total_bytes"),
        F.call_function("div", F.sum("bytes"), F.count(F.lit(1))).alias("avg_bytes"),
        F.min("bytes").alias("min_bytes"),
        F.max("bytes").alias("max_bytes"),
    )
    whole = F.ceil if round_up else F.floor
    after = F.greatest(whole(F.col("total_bytes") / target), F.lit(1))
    eligible = F.col("files") >= min_files
    return per_date.withColumn("files_after", F.when(eligible, after).cast("bigint")).withColumns({
        "reduction_percent": F.call_function(
            "div", (F.col("files") - F.col("files_after")) * 100, F.col("files")),
        "grade": _grade(F.col("files"), min_files),
        "query_speedup": F.when(F.col("files") > 1, F.call_function("div", F.col("files"), F.lit(2))),
    })


def cleanup_report(files: DataFrame, threshold_bytes: int = 1024) -> DataFrame:
    """Totals before and after deleting files of at most ``threshold_bytes``, the numbers of files
    below 1 KB and from 1 to 10 KB whatever the threshold, and a health grade."""
    small = F.col("bytes") <= threshold_bytes
    return files.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(small).alias("small_files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum(F.when(~small, F.col("bytes"))), F.lit(0)).alias("bytes_after"),
        F.coalesce(F.sum(F.when(small, F.col("bytes"))), F.lit(0)).alias("bytes_freed"),
        F.count_if(F.col("bytes") < 1024).alias("small_below_1kb"),
        F.count_if((F.col("bytes") >= 1024) & (F.col("bytes") <= 10240)).alias("small_from_1kb"),
    ).withColumns({
        "reduction_percent": F.coalesce(
            F.try_divide(F.floor(F.try_divide(F.col("bytes_freed") * 10000, F.col("bytes_before"))), F.lit(100)),
            F.lit(0.0)),
        "health": F.when(F.col("small_files") == 0, "healthy")
        .when(F.col("small_files") < 10, "acceptable")
        .when(F.col("small_files") < 100, "moderate")
        .otherwise("high"),
    })


def folder_sizes(files: DataFrame, base: str, depth: int = 1) -> DataFrame:
    """Files and bytes of ``base`` and of the folders down to ``depth`` levels under it, those of
    their subfolders included: rows (depth, folder, files, bytes).

    A rollup over the levels of the path: one pass and one shuffle whatever the depth.
    """
    inside = F.regexp_extract("path", re_escape(base.rstrip("/")) + r"/(?:(.*)/)?[^/]+$", 1)
    levels = [f"_l{i}" for i in range(1, depth + 1)]
    parts = files.where(F.col("path").contains(base.rstrip("/") + "/")).withColumn("_parts", F.split(inside, "/"))
    named = parts.select("bytes", *[F.get("_parts", F.lit(i)).alias(c) for i, c in enumerate(levels)])
    named = named.withColumn("_l1", F.nullif("_l1", F.lit("")))
    rolled = named.rollup(*levels).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.grouping_id().alias("_set"))
    # A set over the first k levels has zeros in the k highest bits. Files that lie higher up have
    # no name at the last of them and count in the sets above only.
    level = F.lit(0)
    for k in range(1, depth + 1):
        level = F.when((F.col("_set") == (1 << (depth - k)) - 1) & F.col(levels[k - 1]).isNotNull(), k).otherwise(level)
    top = F.col("_set") == (1 << depth) - 1
    return rolled.withColumn("depth", level).where(top | (F.col("depth") > 0)).select(
        F.col("depth").cast("bigint").alias("depth"), F.concat_ws("/", *levels).alias("folder"), "files", "bytes")


def re_escape(text: str) -> str:
    """``text`` as a literal inside a Java regular expression."""
    return "\\Q" + text + "\\E"
