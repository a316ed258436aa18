"""Training and evaluation of the accident model."""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scoring import MODEL_FEATURES

# Fitted probabilities all this close to 0 or 1 mean the classes are separable.
SEPARATION = 1e-8
# A step that changes no coefficient by more than this share ends the fit.
CONVERGED = 1e-10
HALVINGS = 10
_X = ["1", *MODEL_FEATURES]
_PAIRS = [(i, j) for i in range(len(_X)) for j in range(i, len(_X))]


def _sums(rows: DataFrame, beta: np.ndarray) -> dict:
    """The normal equations of one weighted least squares step at ``beta``, the deviance there
    and how far the fitted probabilities are from 0 and 1: one aggregate over the rows."""
    x = [F.lit(1.0), *[F.col(name) for name in MODEL_FEATURES]]
    z = F.lit(0.0)
    for b, c in zip(beta, x):
        z = z + F.lit(float(b)) * c
    fitted = rows.withColumn("_z", z).withColumn("_p", 1 / (1 + F.exp(-F.col("_z")))).withColumn(
        "_w", F.col("_p") * (1 - F.col("_p")))
    y, zed, p, w = (F.col(c) for c in ("label", "_z", "_p", "_w"))
    loss = F.log1p(F.exp(-F.abs(zed))) + F.greatest(zed, F.lit(0.0)) - y * zed
    return fitted.agg(
        *[F.sum(w * x[i] * x[j]).alias(f"a{i}_{j}") for i, j in _PAIRS],
        *[F.sum((y - p) * x[i]).alias(f"g{i}") for i in range(len(_X))],
        (2 * F.sum(loss)).alias("deviance"), F.max(F.least(p, 1 - p)).alias("farthest"),
        F.count(F.lit(1)).alias("used"),
    ).first().asDict()


def _matrix(sums: dict) -> tuple[np.ndarray, np.ndarray]:
    hessian = np.zeros((len(_X), len(_X)))
    for i, j in _PAIRS:
        hessian[i, j] = hessian[j, i] = sums[f"a{i}_{j}"]
    return hessian, np.array([sums[f"g{i}"] for i in range(len(_X))])


def train_accident_model(training: DataFrame, max_iter: int = 20, reg_param: float = 0.0) -> DataFrame:
    """Logistic regression of ``has_accident`` by iteratively reweighted least squares, as a
    one-row table.

    Each step is one aggregate over the rows (the sums of the normal equations, 27 numbers); the
    driver solves six equations. A step after which the deviance is larger is halved. Drivers
    with a NULL feature are left out and counted in ``rows_skipped``. ``coef`` holds the
    intercept and one value per feature; ``separable`` flags data on which the coefficients grow
    without bound instead of converging. ``reg_param`` is a ridge penalty per row on
    the features in units of their standard deviations.
    """
    spark = training.sparkSession
    numeric = training.select(F.col("has_accident").cast("double").alias("label"),
                              *[F.col(name).cast("double").alias(name) for name in MODEL_FEATURES])
    rows = numeric.dropna().persist()
    try:
        total = numeric.agg(F.count(F.lit(1))).first()[0]
        penalty = np.zeros(len(_X))
        if reg_param:
            spread = rows.agg(F.count(F.lit(1)).alias("n"), *[F.var_pop(c).alias(c) for c in MODEL_FEATURES]).first()
            penalty[1:] = [reg_param * spread["n"] * spread[c] for c in MODEL_FEATURES]

        def objective(sums: dict, at: np.ndarray) -> float:
            return sums["deviance"] + float((penalty * at * at).sum())

        beta, steps, errors = np.zeros(len(_X)), 0, None
        here = _sums(rows, beta)
        while here["used"] and steps < max_iter:
            hessian, gradient = _matrix(here)
            try:
                step = np.linalg.solve(hessian + np.diag(penalty), gradient - penalty * beta)
            except np.linalg.LinAlgError:
                break
            steps, ahead = steps + 1, _sums(rows, beta + step)
            for _ in range(HALVINGS):
                if objective(ahead, beta + step) <= objective(here, beta) * (1 + 1e-12) + 1e-12:
                    break
                step = step / 2
                ahead = _sums(rows, beta + step)
            beta, here = beta + step, ahead
            if here["farthest"] < SEPARATION or np.max(np.abs(step) / np.maximum(1, np.abs(beta))) < CONVERGED:
                break
    finally:
        rows.unpersist()
    separable = bool(here["used"]) and here["farthest"] < SEPARATION
    if separable:
        warnings.warn("accident model: the classes are separable; pass reg_param", stacklevel=2)
    elif here["used"] and not reg_param:
        try:
            errors = [float(v) for v in np.sqrt(np.diag(np.linalg.inv(_matrix(here)[0])))]
        except np.linalg.LinAlgError:
            errors = None
    coefficients = [float(b) for b in beta]
    return spark.createDataFrame(
        [(coefficients, errors, steps, max(abs(c) for c in coefficients), int(here["used"]),
          int(total - here["used"]), separable)],
        "coef array<double>, std_err array<double>, num_iterations int, max_abs_coef double, "
        "rows_used bigint, rows_skipped bigint, separable boolean",
    )


def coefficients_table(spark: SparkSession, coefficients: list[float]) -> DataFrame:
    """A coefficient table for predicting with known values."""
    return spark.createDataFrame([([float(c) for c in coefficients],)], "coef array<double>")


def confusion(predicted: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows per actual and predicted class (predicted when p is at least ``threshold``)."""
    return (
        predicted.where(F.col("accident_probability").isNotNull())
        .groupBy(
            F.col("has_accident").alias("label"),
            (F.col("accident_probability") >= threshold).cast("int").alias("predicted"),
        )
        .agg(F.count(F.lit(1)).alias("drivers"))
    )


def model_evaluate(predicted: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row with the confusion counts, accuracy and area under the ROC curve."""
    spark = predicted.sparkSession
    known = predicted.where(F.col("accident_probability").isNotNull())
    auc = BinaryClassificationEvaluator(
        rawPredictionCol="accident_probability", labelCol="label", metricName="areaUnderROC", numBins=0
    ).evaluate(known.select(F.col("has_accident").cast("double").alias("label"), "accident_probability"))

    def cell(label: int, guess: int):
        return F.coalesce(
            F.sum(F.when((F.col("label") == label) & (F.col("predicted") == guess), F.col("drivers"))),
            F.lit(0),
        )

    return confusion(predicted, threshold).agg(
        cell(1, 1).alias("true_positive"), cell(0, 1).alias("false_positive"),
        cell(0, 0).alias("true_negative"), cell(1, 0).alias("false_negative"),
    ).withColumns({
        "accuracy": F.try_divide(
            F.col("true_positive") + F.col("true_negative"),
            F.col("true_positive") + F.col("false_positive")
            + F.col("true_negative") + F.col("false_negative")),
        "area_under_roc": F.lit(float(auc)),
    })
