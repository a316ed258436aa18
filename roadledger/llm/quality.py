"""Quality classifier: random Fourier features, ridge by summed normal equations, isotonic scores."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, small_batches, table, with_row_key, without, written
from .features import CLASSES, base_counts, class_counts

FREQUENCIES = 192  # random Fourier features
WIDTH = 4.0  # of the Gaussian kernel, in standard deviations of a statistic
RIDGE = 1e-3  # times the number of labelled rows
SEED = 20240131
BINS = 4096  # of raw scores for the isotonic fit
CUT = 0.3
N_STATISTICS = len(CLASSES) + 12


def statistics(data: bytes) -> list[float]:
    """Numbers in fixed ranges that describe a text; all 0 for an empty one."""
    words, numbers, (chars, symbols, dup_lines, repeated) = base_counts(data)
    n, classes = len(words), class_counts(data)
    if not n:
        return [0.0] * N_STATISTICS
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = data.count(b"\n") + 1
    marks = sum(map(data.count, (b" | ", b"!!", b"***", b"$$$", b"&&&", b"%%%", b"###")))
    same = int((numbers[1:] == numbers[:-1]).sum())
    upper, letters = classes[1], max(1, classes[0] + classes[1])
    return [
        *(classes / max(1, classes.sum())).tolist(),
        math.log1p(n) / 10, math.log1p(float(lengths.mean())), math.log1p(float(lengths.max())) / 10,
        float(lengths.std() / lengths.mean()), len(set(words)) / n if n else 0.0, repeated / n,
        symbols / max(1, chars), dup_lines / lines, same / n, min(1.0, marks / n),
        upper / letters, min(1.0, classes[5] * 5 / n),
    ]


def document_statistics(docs: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, stats) and the ``carried`` long columns: whole texts; null as empty. No other column is read."""
    small_batches(docs.sparkSession)

    def measure(batches):
        for batch in batches:
            stats = [statistics((t or "").encode("utf-8", "surrogatepass"))
                     for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(stats, pa.list_(pa.float64())), *map(batch.column, carried)],
                names=["doc_id", "stats", *carried])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carried).mapInArrow(
        measure, ", ".join(["doc_id long, stats array<double>", *[f"{c} long" for c in carried]]))


class Model:
    """Weights of the fit; a few hundred numbers, whatever the size of the table."""

    def __init__(self, mean, scale, weights, low, high, steps):
        self.mean, self.scale, self.weights = mean, scale, weights
        self.low, self.high, self.steps = low, high, steps

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier((stats - self.mean) / self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return self.steps[_bins(self.raw(stats), self.low, self.high)]


def fourier(x: np.ndarray) -> np.ndarray:
    """cos(xW + b), whose inner products approach a Gaussian kernel; and a constant."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(0.0, 1.0 / WIDTH, (N_STATISTICS, FREQUENCIES))
    b = rng.uniform(0.0, 2 * np.pi, FREQUENCIES)
    z = np.cos(np.clip(x, -8, 8) @ w + b) * math.sqrt(2.0 / FREQUENCIES)
    return np.concatenate([z, np.ones((len(x), 1))], axis=1)


def _bins(raw: np.ndarray, low: float, high: float) -> np.ndarray:
    return np.clip(((raw - low) / max(high - low, 1e-12) * BINS).astype(np.int64), 0, BINS - 1)


def _matrix(batch) -> np.ndarray:
    return batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATISTICS)


def _summed(rows: DataFrame, partial, size: int) -> np.ndarray:
    """The sum over all batches of ``partial(batch)``, a vector of ``size`` numbers.

    Tasks give one vector each; about the root of their number of tasks adds those up, so the
    driver gets few vectors of a size that the table does not change.
    """
    def each(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += partial(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def add(batches):
        total = np.zeros(size)
        for batch in batches:
            for data in batch.column("sums").to_pylist():
                total += np.frombuffer(data)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = rows.mapInArrow(each, "sums binary").repartition(max(1, math.isqrt(tasks))).mapInArrow(add, "sums binary")
    total = np.zeros(size)
    for row in sums.toLocalIterator():
        total += np.frombuffer(row["sums"])
    return total


def fit(labelled: DataFrame) -> Model:
    """Fits all rows (stats, label): three passes over one narrow row per labelled document.

    Without any labelled row the model scores everything 0.5.
    """
    def moments(batch):
        x = _matrix(batch)
        return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])

    n, *rest = _summed(labelled, moments, 1 + 2 * N_STATISTICS)
    size = FREQUENCIES + 1
    if not n:
        return Model(np.zeros(N_STATISTICS), np.ones(N_STATISTICS), np.zeros(size), -1.0, 1.0, np.full(BINS, 0.5))
    mean = np.array(rest[:N_STATISTICS]) / n
    scale = np.sqrt(np.maximum(np.array(rest[N_STATISTICS:]) / n - mean ** 2, 0))
    scale[scale < 1e-9] = 1.0

    def equations(batch):
        z = fourier((_matrix(batch) - mean) / scale)
        y = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    sums = _summed(labelled, equations, size * size + size)
    penalty = np.eye(size) * RIDGE * n
    penalty[-1, -1] = 1e-9  # the constant is free
    weights = np.linalg.solve(sums[:size * size].reshape(size, size) / FREQUENCIES + penalty / FREQUENCIES,
                              sums[size * size:] / FREQUENCIES)
    model = Model(mean, scale, weights, -0.5, 1.5, None)

    def histogram(batch):
        at = _bins(model.raw(_matrix(batch)), model.low, model.high)
        y = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)])

    counts = _summed(labelled, histogram, 2 * BINS)
    model.steps = isotonic(counts[:BINS], counts[BINS:])
    return model


def isotonic(n: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Rising shares of ones per bin by pooling adjacent violators; empty bins between two
    others get the line between them, those outside the nearest share."""
    at = np.flatnonzero(n > 0)
    pools: list[list[float]] = []
    for k in at:
        pools.append([ones[k], n[k], 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    shares = np.concatenate([np.full(int(count), one / total) for one, total, count in pools])
    return np.interp(np.arange(len(n)), at, shares)


def held_out(doc_id):
    """Rows no label is learned from: a fifth, by the id's text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame, *, cut: float = CUT, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, and its ``carried`` long columns.

    Labels outside the held-out fifth are learned from; several rows of labels for one document
    all count, rows with a null label or id do not. Null and empty texts get the score of
    all-zero statistics. Equal texts get equal scores. An empty table gives no rows.
    """
    stats = written(document_statistics(docs, carried), "statistics")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
    known = known.where(F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
    model = fit(written(stats.join(known, "doc_id").select("stats", "label"), "labelled"))

    def score(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(model.score(_matrix(batch))), *map(batch.column, carried)],
                    names=["doc_id", "score", *carried])

    scored = stats.mapInArrow(score, ", ".join(["doc_id long, score double", *[f"{c} long" for c in carried]]))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"), *carried)


def keep_good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier predicts to be good, with their columns. Each row goes or
    stays by its own text, whatever other rows have its doc_id or none."""
    keyed = with_row_key(docs)
    judged = quality(keyed, table(spark, sf_dir, "labels"), carried=ROW)
    return without(keyed, judged.where("predicted = 0"))
