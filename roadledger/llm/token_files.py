"""Token ids as Parquet list columns, written in document order and read back."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from .common import offsets, small_batches
from .tokens import Encoder

SCHEMA = "doc_id long, ids array<int>, n_tokens long, part int, start_in_part long"
# Texts encoded at once.
CHUNK = 128


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, *, spaces: bool, encoding: str = "delta",
    row_group_bytes: int = 32 << 20, page_bytes: int = 1 << 20, partitions: int | None = None,
) -> None:
    """Writes (doc_id, text) as files of token ids in ascending doc_id order.

    Each file is one range of doc_id, sorted, with row groups and pages of the given size.
    ``encoding``: "delta" (version 2 pages, no dictionary: numbers are delta-packed) or
    "dictionary". Parquet's page index (minimum and maximum of each page of doc_id, and the
    place of each page) is part of every file, so a reader that filters by doc_id reads only the
    pages it needs, and one that selects n_tokens reads no ids.

    Null text is empty: its ids are the end id alone. Rows with equal or null doc_id are all
    kept (null first), in the order of a hash of their text, then the text; ranges are cut by
    that hash, too, so that rows without an id spread over many tasks. An empty table gives no rows. Columns other
    than these two are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    # Ranges are cut on the documents, before any work on their texts.
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_hash"))
    ordered = rows.repartitionByRange(n, "doc_id", "_hash").sortWithinPartitions("doc_id", "_hash", "text").drop("_hash")

    def encode(batches):
        from pyspark import TaskContext

        part, start = TaskContext.get().partitionId(), 0
        encoder = Encoder.of(tokenizer, spaces)
        for batch in batches:
            for k in range(0, batch.num_rows, CHUNK):
                rows = batch.slice(k, CHUNK)
                coded = encoder.encode(rows.column("text").to_pylist())
                sizes = np.array([len(x) // 4 for x in coded], dtype=np.int64)
                ids = pa.array(np.frombuffer(b"".join(coded), dtype="<i4"))
                ends = np.concatenate([[0], np.cumsum(sizes)])
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids),
                    pa.array(sizes), pa.array(np.full(len(sizes), part, dtype=np.int32)),
                    pa.array(start + ends[:-1]),
                ], names=["doc_id", "ids", "n_tokens", "part", "start_in_part"])
                start += int(ends[-1])

    (ordered.mapInArrow(encode, SCHEMA).write
     .option("parquet.writer.version", "v2" if encoding == "delta" else "v1")
     .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
     .option("parquet.block.size", str(row_group_bytes))
     .option("parquet.page.size", str(page_bytes))
     .option("compression", "zstd")
     .parquet(path))


def _with_starts(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """start: the ids of all documents before, from the sums of the parts before (one row each)."""
    counts = spark.read.schema(SCHEMA).parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    return rows.join(offsets(counts, "part", "tokens"), "part").withColumn(
        "start", F.col("tokens_before") + F.col("start_in_part"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, ids, n_tokens, start): start counts the ids of all documents before it."""
    files = spark.read.schema(SCHEMA).parquet(path)
    return _with_starts(spark, path, files).select("doc_id", "ids", "n_tokens", "start")


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_tokens``, with ids_crc32 for the ids; the ids themselves are not shuffled."""
    sums = with_checksum(spark.read.schema(SCHEMA).parquet(path))
    return _with_starts(spark, path, sums).select("doc_id", "start", "n_tokens", "ids_crc32")


def with_checksum(rows: DataFrame, ids: str = "ids") -> DataFrame:
    """The list column replaced by ids_crc32 of its little-endian unsigned 32-bit numbers."""
    others = [c for c in rows.columns if c != ids]

    def sums(batches):
        for batch in batches:
            lists = batch.column(ids)
            flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            flat, ends = flat.astype("<u4", copy=False), ends - ends[0]
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], pa.array(crc, pa.int64())], names=[*others, "ids_crc32"])

    types = dict(rows.dtypes)
    return rows.mapInArrow(sums, ", ".join([*[f"`{c}` {types[c]}" for c in others], "ids_crc32 long"]))


def token_rows(docs: DataFrame, tokenizer: str, *, spaces: bool = False) -> DataFrame:
    """Writes the files of ``docs`` to the shared folder and reads them back."""
    path = shared_folder(docs.sparkSession, "token-files")
    write_tokens(docs, path, tokenizer, spaces=spaces)
    return read_checksums(docs.sparkSession, path)
