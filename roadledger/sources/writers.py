"""Writers: telemetry files, score history, and replacing a table as a whole."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SCORE_HISTORY, TELEMETRY_FILE
from .paths import Files, or_empty

# Fixed value: rows per Parquet row group of telemetry files.
ROW_GROUP_ROWS = 50_000

# Options every telemetry writer uses.
TELEMETRY_WRITE_OPTIONS = {
    "compression": "snappy",
    "parquet.enable.dictionary": "true",
    "parquet.block.row.count.limit": str(ROW_GROUP_ROWS),
}


def write_telemetry(
    df: DataFrame,
    path: str,
    *,
    mode: str = "append",
    name: str = "telemetry",
    max_rows_per_file: int = 0,
) -> None:
    """Write telemetry under ``path/date=*/telemetry-*.parquet`` (snappy, dictionary).

    Rows keep the partitioning they arrive in; a caller with many small tasks per date
    compacts afterwards instead of shuffling everything here.
    """
    stored = [c for c in df.columns if c in TELEMETRY_FILE.names]
    (
        df.select(*stored, "date")
        .write.mode(mode)
        .partitionBy("date")
        .options(**TELEMETRY_WRITE_OPTIONS)
        .option("maxRecordsPerFile", max_rows_per_file)
        .option("mapreduce.output.basename", name)
        .parquet(path)
    )


def append_scores(scored: DataFrame, path: str, run_id: str, calculated_at: Column, notes: Column) -> None:
    """Append one run's scores to the history.

    A run owns its own partition: repeating it with the same ``run_id`` and day replaces
    what it wrote, and rows of other runs are never touched. Drivers without a score are
    not recorded.
    """
    rows = scored.where(F.col("safe_driver_score").isNotNull()).select(
        F.concat_ws("-", F.lit(run_id), F.col("driver_id")).alias("score_id"),
        F.col("driver_id").cast("bigint").alias("driver_id"),
        F.col("safe_driver_score").cast("decimal(5,2)").alias("score"),
        calculated_at.alias("calculation_date"),
        notes.alias("notes"),
        F.to_date(calculated_at).alias("calculation_day"),
        F.lit(run_id).alias("run_id"),
    )
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("calculation_day", "run_id")
        .parquet(path)
    )


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """The score history; no rows before the first run."""
    return or_empty(
        spark, SCORE_HISTORY, lambda: spark.read.schema(SCORE_HISTORY).parquet(path)
    )


def overwrite_atomically(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path`` and return it as read back.

    The new rows are complete in a sibling folder before the old table is moved aside, so
    ``df`` may read from ``path`` itself and a failed job leaves the old table in place.
    """
    spark = df.sparkSession
    recover_swap(spark, path)
    files = Files(spark, path)
    fresh, old = f"{path}__new_{uuid.uuid4().hex}", f"{path}__old"
    df.write.mode("errorifexists").parquet(fresh)
    if files.exists(path):
        files.rename(path, old)
    files.rename(fresh, path)
    files.delete(old, recursive=True)
    return spark.read.schema(df.schema).parquet(path)


def recover_swap(spark: SparkSession, path: str) -> bool:
    """Put back the old table if a swap stopped between its two renames."""
    files = Files(spark, path)
    old = f"{path}__old"
    if not files.exists(old):
        return False
    if files.exists(path):
        files.delete(old, recursive=True)
        return False
    files.rename(old, path)
    return True
