"""Documents drawn towards a target distribution: hashed word features, importance weights, noise.

Words come from an untrained regular-expression split of the tokenizers library, with their
offsets; runs of consecutive words are windows between two offsets. A feature falls into the
bucket of its CRC. The corpus and the target are compared by bucket counts over all documents,
a document's weight is the sum of its features' gains, and Gumbel noise from a keyed hash turns
the highest scores into a draw without replacement.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, offsets, small_batches, with_row_key, written

# What stands between words: all of ASCII but letters (lower-cased) and digits.
CUT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CUT = re.compile(CUT)
# Characters split at once, and features a worker remembers the buckets of.
PIECE, KNOWN = 1 << 20, 400_000


class _Buckets(dict):
    """Bucket of a feature: CRC of its UTF-8 bytes modulo ``n``."""

    def __init__(self, n: int):
        self.n = n

    def __missing__(self, feature: str) -> int:
        if len(self) >= KNOWN:
            self.clear()
        self[feature] = bucket = zlib.crc32(feature.encode()) % self.n
        return bucket


class Splitter:
    """Words of a text and the buckets of its runs of 1 to ``max_n`` words."""

    def __init__(self, max_n: int, buckets: int):
        from tokenizers import Regex
        from tokenizers.pre_tokenizers import Split

        self.split = Split(Regex(CUT), "removed").pre_tokenize_str
        self.max_n, self.known = max_n, _Buckets(buckets)
        self.type = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def pieces(self, text: str):
        """The text in parts of about ``PIECE`` characters, cut where no word stands."""
        at = 0
        while len(text) - at > PIECE:
            cut = _CUT.search(text, at + PIECE)
            if not cut:
                break
            yield text[at:cut.start()]
            at = cut.end()
        yield text[at:] if at else text

    def hashed(self, text: str | None) -> tuple[int, bytes]:
        """Number of words, and the buckets of all features as little-endian numbers."""
        lowered = (text or "").encode().lower().decode()  # bytes: A to Z only
        n, out, tail = 0, [], []
        for piece in self.pieces(lowered):
            words = [word for word, _ in self.split(piece)]
            n += len(words)
            out.append(np.fromiter(map(self.known.__getitem__, words), self.type, len(words)))
            if self.max_n > 1:
                # Runs that end in this piece; the first may begin in the one before.
                known, words = len(tail), tail + words
                line, ends = " ".join(words), np.cumsum([len(w) + 1 for w in words])
                for k in range(2, self.max_n + 1):
                    first = max(known - k + 1, 0)
                    runs = [line[ends[i] - len(words[i]) - 1:ends[i + k - 1] - 1]
                            for i in range(first, len(words) - k + 1) if i + k > known]
                    out.append(np.fromiter(map(self.known.__getitem__, runs), self.type, len(runs)))
                tail = words[-(self.max_n - 1):]
        return n, b"".join(x.tobytes() for x in out)


def features(docs: DataFrame, *, max_n: int = 1, buckets: int = 10_000, columns: tuple[str, ...] = ()) -> DataFrame:
    """``columns`` of each row with n_words, n_features and ``hashed``, its features' buckets."""
    small_batches(docs.sparkSession)
    types = dict(docs.dtypes)

    def hash_texts(batches):
        splitter = Splitter(max_n, buckets)
        size = splitter.type.itemsize
        for batch in batches:
            found = [splitter.hashed(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in columns],
                pa.array([n for n, _ in found], pa.int64()), pa.array([len(h) // size for _, h in found], pa.int64()),
                pa.array([h for _, h in found], pa.binary())], names=[*columns, "n_words", "n_features", "hashed"])

    schema = ", ".join([*[f"`{c}` {types[c]}" for c in columns], "n_words long", "n_features long", "hashed binary"])
    return docs.select(*columns, F.col("text").alias("_text")).mapInArrow(hash_texts, schema)


def histogram(hashed: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket over all rows: one partial count per task, then a sum per bucket.
    The driver gets ``buckets`` numbers, whatever the input."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column("hashed"):
                total += np.bincount(np.frombuffer(value.as_buffer(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    sums = hashed.select("hashed").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in sums.collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target share over corpus share per bucket, one added to
    each count, rounded down."""
    n, s, t = len(corpus), corpus.astype(float), target.astype(float)
    ratio = (t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def weighted(hashed: DataFrame, gain: np.ndarray) -> DataFrame:
    """``hashed`` replaced by ``weight``, the sum of its features' gains (none: 0)."""
    others, types = [c for c in hashed.columns if c != "hashed"], dict(hashed.dtypes)
    kind = "<u2" if len(gain) <= 1 << 16 else "<u4"

    def weigh(batches):
        for batch in batches:
            sums = [int(gain[np.frombuffer(v.as_buffer(), kind)].sum()) for v in batch.column("hashed")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], pa.array(sums, pa.int64())], names=[*others, "weight"])

    return hashed.mapInArrow(weigh, ", ".join([*[f"`{c}` {types[c]}" for c in others], "weight long"]))


def resample(
    docs: DataFrame, target: DataFrame, *, max_n: int = 1, buckets: int = 10_000, percent: int = 10,
    min_words: int = 20, seed: str = "2024", carry: tuple[str, ...] = (),
) -> DataFrame:
    """All documents with weight, score and, for those drawn, their rank.

    Drawn are the ``percent`` percent (rounded down) highest scores of the documents with at
    least ``min_words`` words, ties to the smaller doc_id. The noise in a score depends on
    ``seed`` and doc_id only, so a draw can be repeated.

    ``carry`` names columns of ``docs`` to hand on (``text``, say); others are not read, so
    columns named like results do no harm. Null or empty text: no features, weight 0. Null
    doc_id: noise as of an empty id, last among ties. Equal doc_ids: each row counts, ties by
    text; wholly equal rows get neighbouring ranks. Very long texts are split piece by piece.
    Empty ``docs`` give no rows; an empty ``target`` counts as one without features. Ranks come
    from a sort in ranges of score, so no task sees all documents.
    """
    own = {"doc_id", "n_words", "n_features", "weight", "score", "rank", "hashed", *ROW}
    if own & set(carry):
        raise ValueError(f"carried columns clash with results: {sorted(own & set(carry))}")
    keyed = with_row_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                                     *[c for c in carry if c != "text"]))
    kept = ("doc_id", *ROW, *carry)
    hashed = written(features(keyed, max_n=max_n, buckets=buckets, columns=kept), "features")
    wanted = features(target.select("text"), max_n=max_n, buckets=buckets)
    gain = gains(histogram(hashed, buckets), histogram(wanted, buckets))

    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(key, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    scored = weighted(hashed, gain).withColumn("score", (F.col("weight") + noise).cast("long"))

    able = scored.where(F.col("n_words") >= min_words).withColumn("_place", F.monotonically_increasing_id())
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), *ROW, "_place"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The number made after the sort holds the partition (upper bits) and the place in it.
    ranged = written(able.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                     .withColumn("_place", F.monotonically_increasing_id()), "scored")
    part = F.shiftright("_place", 33).alias("_part")
    counts = ranged.groupBy(part).agg(F.count("*").alias("n"))
    drawn = (counts.agg(F.sum("n")).first()[0] or 0) * percent // 100
    place = F.col("n_before") + F.col("_place").bitwiseAND((1 << 33) - 1) + 1
    ranked = ranged.withColumn("_part", part).join(offsets(counts, "_part", "n"), "_part").withColumn(
        "rank", F.when(place <= drawn, place).cast("long"))
    names = ["doc_id", *carry, "n_words", "n_features", "weight", "score"]
    rest = scored.where(F.col("n_words") < min_words)
    return ranked.select(*names, "rank").unionAll(rest.select(*names, F.lit(None).cast("long").alias("rank")))
