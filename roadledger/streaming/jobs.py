"""High-force alerts, windowed driver features and periodic rescoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions import event_ts, weighted_notes
from ..operators.activity import high_gforce_events
from ..operators.mergeable import PARTIAL, combine_features, merge_partials, partial_features
from ..operators.scoring import score_weighted
from ..operators.training import training_data
from ..schemas import TELEMETRY, TELEMETRY_FILE, struct, with_columns
from ..sources import append_scores
from ..sources.paths import Files
from ..sources.telemetry import TELEMETRY_FILES

_WINDOW = ("driver_id", "window_start", "window_end")
FEATURE_WINDOWS = StructType([
    *struct("driver_id BIGINT, window_start TIMESTAMP, window_end TIMESTAMP").fields,
    *PARTIAL.fields,
    *struct("batch_id BIGINT").fields,
])
_WINDOWS = StructType(FEATURE_WINDOWS.fields[:-1])
# Folders of a level that are merged to one of the next.
TIER = 16


def telemetry_stream(spark: SparkSession, base: str, *, pattern: str = TELEMETRY_FILES,
                     max_files: int | None = None) -> DataFrame:
    """Telemetry files under ``base/date=*`` as a stream of canonical rows."""
    schema = with_columns(TELEMETRY_FILE, "date DATE")
    reader = spark.readStream.schema(schema).option("basePath", base).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.parquet(f"{base}/date=*")
        .withColumn("event_ts", event_ts(F.col("event_time"))).select(*TELEMETRY.names)
    )


def _trigger(writer, every: str | None):
    """Run every interval, or once over what is there for ``every=None``."""
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def stream_high_gforce(tel: DataFrame, sink: str, checkpoint: str, every: str | None = "10 seconds",
                       min_g: float = 2.0) -> StreamingQuery:
    """Write events of at least ``min_g`` to ``sink`` as they arrive; stateless."""
    writer = (
        high_gforce_events(tel, min_g).writeStream.outputMode("append").format("parquet")
        .option("path", sink).option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, every).start()


def feature_windows(tel: DataFrame, window: str = "5 minutes") -> DataFrame:
    """Mergeable features per driver and tumbling window."""
    partials = partial_features(
        tel.where(F.col("driver_id").isNotNull()), F.window("event_ts", window).alias("w"))
    return partials.select(
        F.col("driver_id").cast("bigint").alias("driver_id"),
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *PARTIAL.names,
    )


def stream_features(tel: DataFrame, sink: str, checkpoint: str, every: str | None = "5 minutes",
                    window: str = "5 minutes") -> StreamingQuery:
    """Add the feature windows of each batch of a telemetry stream to ``sink``.

    A batch is reduced to one partial per driver and window and written as ``batch_id=N``;
    partials of a window from several batches merge, see :func:`merged_windows`. So no state is
    kept between batches and no event is ever too late, whatever the order of files. Repeating
    a batch rewrites its own folder, so a restart neither loses nor doubles anything.

    Every ``TIER`` batches are merged to a folder of the next level, every ``TIER`` of those to
    one of the level above, and so on: readers take the largest folders, a number that grows
    with the logarithm of the number of batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        feature_windows(batch, window).write.mode("overwrite").parquet(_folder(sink, 0, batch_id))
        level, done = 1, batch_id + 1
        while done % TIER == 0:
            done //= TIER
            below = [_folder(sink, level - 1, k) for k in range((done - 1) * TIER, done * TIER)]
            merged = merged_windows(batch.sparkSession.read.schema(_WINDOWS).parquet(*below))
            merged.select(*_WINDOWS.names).write.mode("overwrite").parquet(_folder(sink, level, done - 1))
            level += 1

    return _trigger(tel.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), every).start()


def merged_windows(parts: DataFrame) -> DataFrame:
    """Every driver's windows, the partials of all batches merged."""
    return merge_partials(parts, *_WINDOW)


def _folder(sink: str, level: int, number: int) -> str:
    """Of a batch, or of the ``number``-th group of ``TIER`` ** ``level`` batches."""
    return f"{sink}/batch_id={number}" if level == 0 else f"{sink}/level={level}/part={number}"


def tier_folders(spark: SparkSession, sink: str, last: int) -> list[str]:
    """The fewest folders that hold each batch from 0 to ``last`` once.

    The number of batches, written to the base of ``TIER``, tells the folders; no listing is
    needed. Where a merged folder is not complete yet, its parts take its place.
    """
    files = Files(spark, sink)

    def whole(level: int, number: int) -> list[str]:
        folder = _folder(sink, level, number)
        # Spark's marker of a finished write.
        if level == 0 or files.exists(f"{folder}/_SUCCESS"):
            return [folder]
        return [f for k in range(number * TIER, (number + 1) * TIER) for f in whole(level - 1, k)]

    found, level, left = [], 0, last + 1
    while left:
        left, rest = divmod(left, TIER)
        for k in range(rest):
            found += whole(level, left * TIER + k)
        level += 1
    return found


def read_windows(spark: SparkSession, sink: str, last: int | None = None) -> DataFrame:
    """The partials of all batches, or of those up to ``last``."""
    if last is None:
        names = [name for name, _ in Files(spark, sink).states(sink) if name.startswith("batch_id=")]
        last = max((int(name[9:]) for name in names), default=-1)
    if last < 0:
        return spark.createDataFrame([], _WINDOWS)
    return spark.read.schema(_WINDOWS).parquet(*tier_folders(spark, sink, last))


def stream_scores(spark: SparkSession, windows: str, accidents: DataFrame, history: str,
                  checkpoint: str, every: str | None = "30 minutes", name: str = "stream") -> StreamingQuery:
    """Rescore the drivers whose feature windows changed and append to the history.

    Each batch reads all windows of just those drivers, from the few folders that hold all
    feature batches up to the newest one it has. The batch id names the run and the newest
    window end dates it, so repeating a batch replaces its own rows.
    """

    def rescore(changed: DataFrame, batch_id: int) -> None:
        if changed.isEmpty():
            return
        newest = changed.agg(F.max("window_end")).scalar()
        last = changed.agg(F.max("batch_id")).first()[0]
        drivers = changed.select("driver_id").distinct()
        mine = read_windows(changed.sparkSession, windows, last).join(drivers, "driver_id", "left_semi")
        features = combine_features(mine, F.current_timestamp())
        scored = score_weighted(training_data(features, accidents))
        append_scores(scored, history, f"{name}-{batch_id}", newest, weighted_notes())

    source = spark.readStream.schema(FEATURE_WINDOWS).option("basePath", windows) \
        .parquet(f"{windows}/batch_id=*")
    writer = source.writeStream.foreachBatch(rescore).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()
