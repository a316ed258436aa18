"""Which telemetry files count while small files are being replaced by merged ones.

A compaction run adds merged files to the date folders and later deletes the files it merged.
In between both are there, so each run has a marker in ``_compaction`` whose name tells its
state: ``<run>.pending`` until its merged files are complete and checked, ``<run>.committed``
from then on. One rename takes the run from the first state to the second, for all its dates
at once. A scan lists files first and markers second and leaves out

- the merged files of a pending run, by their name, and
- the files a committed run has merged, by the list the run stored beside its marker.

So it sees the rows of a date once at any moment, and after a crash at any moment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import struct
from .paths import Files

WORK = "_compaction"
PENDING, COMMITTED = ".pending", ".committed"
# Files merged by a run: their date folder, name and rows (by footer).
MERGED = struct("date DATE, name STRING, rows BIGINT")


def runs(spark: SparkSession, base: str) -> dict[str, str]:
    """State of each unfinished run, from the names of the markers: one listing."""
    files, work = Files(spark, base), f"{base}/{WORK}"
    if not files.exists(work):
        return {}
    found = {}
    for name in files.names(work):
        for state in (PENDING, COMMITTED):
            if name.endswith(state):
                found[name[:-len(state)]] = state
    return found


def merged_by(spark: SparkSession, base: str, run: str) -> DataFrame:
    """The files that ``run`` has merged."""
    return spark.read.schema(MERGED).parquet(f"{base}/{WORK}/{run}/merged")


def without_files(scan: DataFrame, files: DataFrame) -> DataFrame:
    """``scan`` without the rows of ``files`` (date, name): a file is in or out as a whole."""
    gone = files.select(F.col("date").alias("_date"), F.col("name").alias("_name"))
    columns = scan.columns
    return scan.select("*", F.col("_metadata.file_name").alias("_file")).join(
        gone, (F.col("_file") == F.col("_name")) & F.col("date").eqNullSafe(F.col("_date")), "left_anti").select(*columns)


def only_live(scan: DataFrame, base: str) -> DataFrame:
    """``scan`` without rows of files that do not count now. Call it right after the files were
    listed: a run that starts later adds nothing to them."""
    spark, merged = scan.sparkSession, None
    for run, state in runs(spark, base).items():
        if state == PENDING:
            # A condition on file metadata alone drops files before they are opened.
            scan = scan.where(~F.col("_metadata.file_name").contains(run))
        else:
            more = merged_by(spark, base, run)
            merged = more if merged is None else merged.unionAll(more)
    return scan if merged is None else without_files(scan, merged)
