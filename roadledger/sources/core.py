"""Customer, policy, vehicle, driver, accident and claim tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import CORE
from .paths import or_empty


def load_core(spark: SparkSession, folder: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The six reference tables by name, from ``folder/<name>`` (Parquet, or CSV with header)."""
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"unsupported format {fmt!r}")

    def table(name: str) -> DataFrame:
        reader = spark.read.schema(CORE[name])
        if fmt == "csv":
            # Columns are matched to the header by name, so a file may omit trailing ones.
            reader = reader.option("header", "true").option("enforceSchema", "false")
        return or_empty(spark, CORE[name], lambda: reader.format(fmt).load(f"{folder}/{name}"))

    return {name: table(name) for name in CORE}
