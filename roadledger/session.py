"""Session settings and the folder shared by all executors."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for. Joins carry no broadcast hints: a side is
# broadcast only when its measured size is under these limits, and joined by shuffle
# (with skewed partitions split at run time) when it is not.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "roadledger", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir`` or, where that is not set, under
    the warehouse: executors reach both.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def released_shuffles(spark: SparkSession):
    """Shuffle files of what is written inside are deleted as soon as it is written.

    Nothing reads them again: later steps start from the written table. The session's own
    setting is put back afterwards.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialized(df: DataFrame, purpose: str, *by: str) -> DataFrame:
    """``df`` written once to a shared folder and read back.

    For small results that several plans start from: the work before them is not repeated,
    survives the loss of executors, and the planner knows the table's real size. ``by``: columns
    that name its folders, so that a reader of some values reads no others.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    with released_shuffles(spark):
        df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
