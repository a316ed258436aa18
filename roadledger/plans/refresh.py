"""The score refresh: from new telemetry to scores, alerts and a retrained model."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import instant, logistic_notes, weighted_notes
from ..operators import scoring, training
from ..operators.mergeable import combine_features
from ..operators.model import train_accident_model
from ..sources import append_scores, load_core, overwrite_atomically, recover_swap
from ..sources.paths import Files
from .compaction import remove_tiny
from .days import update_days
from .snapshot import refreshed_scores


@dataclass(frozen=True)
class RefreshConfig:
    """Where a refresh reads and keeps its state."""

    telemetry: str
    core: str
    home: str
    delete_tiny_files: bool = False
    core_format: str = "parquet"
    max_iter: int = 20
    reg_param: float = 0.0

    @property
    def features(self) -> str:
        return f"{self.home}/driver_behavior_features"

    @property
    def training(self) -> str:
        return f"{self.home}/driver_ml_training_data"

    @property
    def model(self) -> str:
        return f"{self.home}/driver_accident_model"

    @property
    def history(self) -> str:
        return f"{self.home}/safe_driver_scores"


@dataclass(frozen=True)
class RefreshResult:
    """What a refresh did. The DataFrames are small summaries, evaluated when used.

    ``skipped`` lists the files of the days it read that are damaged, with the number of rows
    that cannot be read; none of the rows of such a file count.
    """

    status: str
    retrained: bool = False
    current: DataFrame | None = None
    statistics: DataFrame | None = None
    alert: DataFrame | None = None
    distribution: DataFrame | None = None
    skipped: DataFrame | None = None


def refresh(spark: SparkSession, config: RefreshConfig, as_of: datetime, force: bool = False) -> RefreshResult:
    """Recalculate all driver scores if telemetry changed, or if forced.

    Files that came late for an old date count, and so do removed ones; rows without a driver
    count once, with the files they came in. Only date folders that changed since the last run are read; see :mod:`.days`. Features
    and training data are written as tables and read back, so later steps start from one
    row per driver whatever happens to the executors that did the work before.
    ``as_of`` also names the run: repeating a run replaces what it wrote.
    """
    if config.delete_tiny_files:
        remove_tiny(spark, config.telemetry, dry_run=False)
    update = update_days(spark, config.telemetry, config.home)
    accidents = load_core(spark, config.core, config.core_format)["accidents"]

    for table in (config.features, config.training, config.model):
        recover_swap(spark, table)
    if not force and not update.changed and not update.gone and Files(spark, config.home).exists(config.features):
        return RefreshResult(status="NO_NEW_DATA")

    run_id = as_of.strftime("%Y%m%dT%H%M%S")
    features = overwrite_atomically(combine_features(update.months, as_of), config.features)
    examples = overwrite_atomically(training.training_data(features, accidents), config.training)
    append_scores(scoring.score_weighted(examples), config.history, f"{run_id}-weighted",
                  instant(as_of), weighted_notes())

    retrain = force or (as_of.isoweekday() == 7 and _recent_accidents(accidents, as_of))
    if retrain:
        model = retrain_only(spark, config)
        append_scores(scoring.score_logistic(examples, model), config.history, f"{run_id}-model",
                      instant(as_of) + F.expr("INTERVAL '1' SECOND"), logistic_notes(retrained=True))

    update.settle()
    current = refreshed_scores(spark, config.history, f"{config.home}/current_scores").scores
    return RefreshResult(
        status="REFRESHED",
        retrained=retrain,
        current=current,
        statistics=scoring.refresh_statistics(current),
        alert=scoring.high_risk_alert(current),
        distribution=scoring.score_distribution(current),
        skipped=update.skipped,
    )


def _recent_accidents(accidents: DataFrame, as_of: datetime, days: int = 7) -> bool:
    since = instant(as_of) - F.expr(f"INTERVAL '{days}' DAY")
    return not accidents.where(F.col("created_at") > since).isEmpty()


def retrain_only(spark: SparkSession, config: RefreshConfig, max_iter: int | None = None) -> DataFrame:
    """Train on the existing training data and store the fitted coefficients."""
    examples = spark.read.parquet(config.training)
    fitted = train_accident_model(examples, max_iter or config.max_iter, config.reg_param)
    return overwrite_atomically(fitted, config.model)
