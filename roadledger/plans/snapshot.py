"""Current scores kept as a table keyed by driver, instead of a rank over all history.

The history grows with every run; the snapshot has one row per driver and remembers which run
folders it has seen and when they changed. A refresh reads only runs that are new or were
written again, and merges their rows into it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scoring import current_scores, latest_scores
from ..schemas import SCORE_HISTORY, struct, with_columns
from ..sources import overwrite_atomically, read_scores, recover_swap
from ..sources.paths import Files, or_empty

_RUNS = struct("run STRING, changed BIGINT")
_SNAPSHOT = with_columns(SCORE_HISTORY, "run STRING")


@dataclass(frozen=True)
class CurrentScores:
    """Current scores, and the run folders that were read to bring them up to date."""

    scores: DataFrame
    read: list[str]


def _rows(spark: SparkSession, history: str, runs: list[str] | None = None) -> DataFrame:
    """History rows with the folder of their run; of some runs only, if given."""
    rows = read_scores(spark, history) if runs is None else or_empty(
        spark, SCORE_HISTORY, lambda: spark.read.schema(SCORE_HISTORY).option("basePath", history)
        .parquet(*[f"{history}/{run}" for run in runs]))
    return rows.withColumn("run", F.format_string("calculation_day=%s/run_id=%s", F.col("calculation_day").cast("string"), "run_id"))


def refreshed_scores(spark: SparkSession, history: str, saved: str) -> CurrentScores:
    """The current scores of ``history``, from the snapshot at ``saved`` and the runs since.

    A run that was written again or removed takes its old rows out of the snapshot; drivers
    whose row came from it are looked up in the history anew, the others are not. The list of
    runs is stored last, so work that stops before that is done again.
    """
    table, seen = f"{saved}/scores", f"{saved}/runs"
    for path in (table, seen):
        recover_swap(spark, path)
    now = {"/".join(path.rstrip("/").split("/")[-2:]): changed for path, changed in
           Files(spark, history).changes(f"{history}/calculation_day=*/run_id=*").items()}
    then = {r["run"]: r["changed"] for r in or_empty(
        spark, _RUNS, lambda: spark.read.schema(_RUNS).parquet(seen)).collect()}
    fresh = sorted(run for run, changed in now.items() if then.get(run) != changed)
    stale = sorted((set(then) - set(now)) | (set(fresh) & set(then)))

    def kept() -> DataFrame:
        return or_empty(spark, _SNAPSHOT, lambda: spark.read.schema(_SNAPSHOT).parquet(table))

    if fresh or stale:
        parts = [kept().where(~F.col("run").isin(stale)) if stale else kept()]
        if fresh:
            parts.append(_rows(spark, history, fresh))
        if stale:
            lost = kept().where(F.col("run").isin(stale)).select("driver_id").distinct()
            parts.append(_rows(spark, history).join(lost, "driver_id", "left_semi"))
        merged = parts[0]
        for part in parts[1:]:
            merged = merged.unionByName(part)
        overwrite_atomically(latest_scores(merged).select(*_SNAPSHOT.names), table)
        overwrite_atomically(spark.createDataFrame(sorted(now.items()), _RUNS), seen)
    return CurrentScores(current_scores(kept()), fresh)
