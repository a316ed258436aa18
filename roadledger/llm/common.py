"""Reading, shared tables, running positions and connected components for the operators."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialized

# Rows a Python batch gets from the JVM at once: texts may be long.
BATCH_ROWS = 512
PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Python gets texts in batches bounded in rows (and, by Spark's setting, in bytes).

    Workers look for this package where the driver has it, too: there it is in local mode and
    where the library is installed on every machine.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *filter(None, paths)])


# A row's key: 128 bits of its doc_id and text. Verdicts depend on those only.
ROW = ("_row1", "_row2")


def with_row_key(docs: DataFrame) -> DataFrame:
    values = [F.col("doc_id").cast("long"), F.col("doc_id").isNull(), "text", F.col("text").isNull()]
    return docs.withColumns({ROW[0]: F.xxhash64(*values), ROW[1]: F.xxhash64(F.lit(1), *values)})


def without(keyed: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``keyed`` whose key is not among ``rows``, without the key. Rows that share
    only their doc_id, null or not, are told apart by their text.

    A list of documents grows with the corpus, so it is never broadcast: the same merge join at
    every size.
    """
    return keyed.join(rows.select(*ROW).distinct().hint("merge"), list(ROW), "left_anti").drop(*ROW)


def written(df: DataFrame, purpose: str, *by: str) -> DataFrame:
    """``df`` as a table in the shared folder, so that lost executors cost no earlier work."""
    return materialized(df, f"llm-{purpose}", *by)


def dropped(*tables: DataFrame) -> None:
    """Deletes working tables (of ``written``) that no later plan reads."""
    for df in tables:
        files = df.inputFiles()
        if files:
            folder = files[0].rsplit("/", 1)[0]
            while "=" in folder.rsplit("/", 1)[1]:
                folder = folder.rsplit("/", 1)[0]
            if not folder.rsplit("/", 1)[1].startswith("llm-"):
                raise ValueError(f"not a working table: {folder}")
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def offsets(counts: DataFrame, part: str, *values: str) -> DataFrame:
    """Per partition number, the sum of each value over all smaller numbers.

    ``counts`` has one row per partition of a written table: as many rows as tasks.
    """
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        part, *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"{v}_before") for v in values])


def components(edges: DataFrame, a: str = "a", b: str = "b", purpose: str = "components") -> DataFrame:
    """Connected components of undirected edges: rows (node, component), component being the
    smallest node reached. Nodes without an edge to another node have no row.

    Alternating large-star and small-star steps. A hub is pre-aggregated (its minimum is a
    partial aggregate) and the join that spreads it is split at run time. Each round is a
    written table; the driver sees only whether there is work left.
    """
    def table_of(e: DataFrame) -> DataFrame:
        return written(e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                       .distinct(), purpose)

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        """pairs: (u, v), v a neighbour of u (all of them, or only the smaller ones)."""
        low = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = pairs.join(low, "u")
        if large:
            return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            low.select("u", F.col("m").alias("v")))

    links = table_of(edges.select(F.col(a).alias("u"), F.col(b).alias("v")))
    while True:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = table_of(star(both, True))
        dropped(links)
        links = table_of(star(large, False))
        dropped(large)
        # Edges lead down. If no node both leads and is led to, each component is one star.
        inner = links.join(links.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
        if not inner.limit(1).count():
            break
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


