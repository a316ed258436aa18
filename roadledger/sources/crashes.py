"""Crash-report Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..schemas import CRASH, CRASH_FILE_NAMES
from .paths import or_empty

_FOLDERS = [StructField("severity_level", StringType()), StructField("report_date", DateType())]


def bind_by_position(df: DataFrame, schema: StructType) -> DataFrame:
    """Give the columns of ``df`` the names and types of ``schema``, by position."""
    if len(df.columns) != len(schema):
        raise ValueError(f"{len(df.columns)} columns cannot bind to {len(schema)} fields")
    named = df.toDF(*schema.names)
    return named.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def crash_reports(
    spark: SparkSession,
    base: str,
    *,
    by_position: bool = False,
    pattern: str = "part-*.parquet",
    skip_corrupt: bool = False,
) -> DataFrame:
    """Crash reports under ``base/severity_level=*/report_date=*``.

    Both folder columns are part of the result. Columns are bound by name, accepting the
    names used inside the files (``accident_timestamp``, ``accident_type``);
    ``by_position`` binds the file's columns in order whatever they are called.
    """
    full = StructType(CRASH.fields + _FOLDERS)
    place = f"{base}/severity_level=*/report_date=*"

    def options(reader):
        return (
            reader.option("basePath", base).option("pathGlobFilter", pattern)
            .option("ignoreCorruptFiles", str(skip_corrupt).lower())
        )

    def read() -> DataFrame:
        if by_position:
            raw = options(spark.read).parquet(place)
            body = [c for c in raw.columns if c not in ("severity_level", "report_date")]
            return bind_by_position(raw.select(*body, "severity_level", "report_date"), full)
        aliases = [StructField(CRASH_FILE_NAMES[f.name], f.dataType)
                   for f in CRASH if f.name in CRASH_FILE_NAMES]
        raw = options(spark.read.schema(StructType(CRASH.fields + aliases + _FOLDERS))).parquet(place)
        both = {
            declared: F.coalesce(F.col(declared), F.col(stored))
            for declared, stored in CRASH_FILE_NAMES.items()
        }
        return raw.withColumns(both).select(*full.names)

    return or_empty(spark, full, read)
