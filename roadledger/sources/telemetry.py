"""Telemetry Parquet, current and legacy layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions import event_ts
from ..schemas import TELEMETRY, TELEMETRY_FILE, TELEMETRY_FILE_V1, with_columns
from .manifest import only_live, without_files
from .paths import Files, or_empty

TELEMETRY_FILES = "telemetry-*.parquet"


def _reader(spark: SparkSession, schema: StructType, base: str, pattern: str, skip_corrupt: bool):
    return (
        spark.read.schema(schema)
        .option("basePath", base)
        .option("pathGlobFilter", pattern)
        .option("ignoreCorruptFiles", str(skip_corrupt).lower())
    )


def _places(spark: SparkSession, base: str, date_glob: str, dates: list[str] | None) -> list[str]:
    """Folders to read: those matching the glob, or those of ``dates`` that exist (one listing)."""
    if dates is None:
        return [f"{base}/date={date_glob}"]
    there = {name for name, _ in Files(spark, base).states(base)}
    return [f"{base}/date={day}" for day in dates if f"date={day}" in there]


def telemetry(
    spark: SparkSession,
    base: str,
    *,
    date_glob: str = "*",
    pattern: str = TELEMETRY_FILES,
    skip_corrupt: bool = False,
    dates: list[str] | None = None,
    without: DataFrame | None = None,
) -> DataFrame:
    """Telemetry under ``base/date=*/telemetry-*.parquet`` with decoded ``event_ts``.

    ``date`` comes from the folder name, so a predicate on it prunes folders;
    ``date_glob`` (``2024-01-*``) or a list of ``dates`` keeps other folders from being listed
    at all. ``without`` (date, path of files, as :func:`skipped_files` lists them) leaves files
    out whole. With ``skip_corrupt`` unreadable files, and the rows after the damage in a partly readable one,
    are left out; :func:`skipped_files` reports both. Size alone leaves nothing out. A missing
    path gives no rows. While a compaction replaces files, rows count once (see :mod:`.manifest`).
    """
    schema = with_columns(TELEMETRY_FILE, "date DATE")

    def read() -> DataFrame:
        places = _places(spark, base, date_glob, dates)
        if not places:
            return spark.createDataFrame([], TELEMETRY)
        df = _reader(spark, schema, base, pattern, skip_corrupt).parquet(*places)
        if without is not None:
            df = without_files(df, without.select("date", F.regexp_extract("path", r"([^/]+)$", 1).alias("name")))
        df = only_live(df, base)
        return df.withColumn("event_ts", event_ts(F.col("event_time"))).select(*TELEMETRY.names)

    return or_empty(spark, TELEMETRY, read)


def telemetry_v1(
    spark: SparkSession,
    base: str,
    *,
    pattern: str = TELEMETRY_FILES,
    date_in_path: str = r"/(?:date=)?(\d{4}-\d{2}-\d{2})/",
    driver_in_path: str = r"/(?:driver_id=|driver_id_partition=)?(\d+)/[^/]+$",
) -> DataFrame:
    """Legacy telemetry as canonical rows plus ``driver_id_partition``.

    Its folders are documented in two ways (``D/N/`` and ``policy_id=/year=/month=/date=D/``),
    so both values are taken from each file's path by the given patterns. A predicate on
    either is then one on file metadata, which drops files before they are opened.
    """
    out = with_columns(TELEMETRY, "driver_id_partition BIGINT")

    def read() -> DataFrame:
        df = _reader(spark, TELEMETRY_FILE_V1, base, pattern, False) \
            .option("recursiveFileLookup", "true").parquet(base)
        place = F.col("_metadata.file_path")
        return (
            df.withColumns({
                "event_ts": F.col("event_time"),
                "date": F.regexp_extract(place, date_in_path, 1).try_cast("date"),
                "driver_id_partition": F.regexp_extract(place, driver_in_path, 1).try_cast("bigint"),
            })
            .withColumn("event_time", F.col("event_time").cast(StringType()))
            .select(*out.names)
        )

    return or_empty(spark, out, read)


def skipped_files(
    spark: SparkSession, base: str, *, pattern: str = TELEMETRY_FILES, date_glob: str = "*",
    dates: list[str] | None = None,
) -> DataFrame:
    """What a scan with ``skip_corrupt`` loses: (date, path, bytes, rows_lost, reason).

    Per file, the rows its footer counts are compared with the rows that all its columns can be
    read for. ``rows_lost`` is null for a file without a readable footer.
    """
    from ..operators.inventory import list_files

    # The two sides spell the scheme differently, so files are matched by folder and name.
    def place(path: str):
        return F.regexp_extract(F.col(path), r"(date=[^/]+/[^/]+)$", 1)

    def counted(name: str, of) -> DataFrame:
        return (
            _reader(spark, TELEMETRY_FILE, base, pattern, True).parquet(*places)
            .select(place("_metadata.file_path").alias("_place"), of.alias("_of"))
            .groupBy("_place").agg(F.count_if(F.col("_of") != 0).alias(name))
        )

    places = _places(spark, base, date_glob, dates)
    files = list_files(spark, base, pattern=pattern, date_glob=None if dates is not None else date_glob, dates=dates).withColumn("_place", place("path"))
    in_footer = counted("in_footer", F.lit(1))  # needs no column, so only footers are read
    # A hash over all columns (never 0, as good as) makes the reader decode every page.
    read = counted("rows_read", F.xxhash64(*[F.col(f.name) for f in TELEMETRY_FILE]))
    lost = F.col("in_footer") - F.coalesce("rows_read", F.lit(0))
    return (
        files.join(in_footer, "_place", "left").join(read, "_place", "left")
        .where(F.col("in_footer").isNull() | (lost > 0))
        .select("date", "path", "bytes", lost.alias("rows_lost"),
                F.when(F.col("in_footer").isNull(), "no readable footer").otherwise("damaged").alias("reason"))
    )
