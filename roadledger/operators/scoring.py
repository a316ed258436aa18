"""Driver scores, their history, summaries and alerts.

Two scores exist and are never mixed silently: the weighted formula, which a normal
refresh records, and the score derived from the accident model.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exact, risk_category
from ..functions.labels import band

# Inputs of the accident model, in the order of its coefficients after the
# intercept.
MODEL_FEATURES = ("speed_compliance_rate", "avg_g_force", "harsh_driving_events",
                  "phone_usage_rate", "speed_variance")

# Bands of the composite score.
COMPOSITE_BANDS = ((90, "EXCELLENT"), (80, "GOOD"), (60, "AVERAGE"), (40, "POOR"))

# Alert rules as (condition, trigger text, severity, message, action).
ALERT_RULES = (
    ("safe_driver_score < 40", "safety_score < 40", "critical",
     "Driver {driver_id} flagged as HIGH_RISK", "immediate_intervention"),
    ("harsh_driving_events > 3", "harsh_driving_events > 3", "warning",
     "Aggressive driving detected for {driver_id}", "coaching_recommendation"),
    ("phone_usage_rate > 30", "phone_usage_rate > 30", "warning",
     "Excessive phone usage: {driver_id}", "distraction_training"),
)

HIGH_RISK_BELOW = 60

_DETAIL = ("total_events", "speed_compliance_rate", "avg_g_force", "harsh_driving_events",
           "phone_usage_rate", "accident_count")


def _d(number: str) -> Column:
    return F.lit(Decimal(number))


def _at_least_zero(value: Column) -> Column:
    """``GREATEST(0, value)``: NULL counts as 0, as GREATEST skips NULLs."""
    return F.greatest(_d("0"), value)


def score_weighted(training: DataFrame) -> DataFrame:
    """Weighted score (accidents 25, compliance 30, phone 20, harsh 15, deviation 10) in DECIMAL.

    A driver with a single event has no speed deviation and gets the full 10 points for it.
    """
    accidents = F.col("accident_count").cast("decimal(12,0)")
    harsh = F.col("harsh_driving_events").cast("decimal(12,0)")
    score = (
        _at_least_zero(_d("25") - accidents * _d("12.5"))
        + F.col("speed_compliance_rate") * _d("0.30")
        + _at_least_zero(_d("20") - F.col("phone_usage_rate") * _d("0.40"))
        + _at_least_zero(_d("15") - harsh * _d("0.025"))
        + _at_least_zero(_d("10") - _at_least_zero(F.col("speed_variance") - _d("6")) * _d("0.65"))
    )
    return training.withColumn("safe_driver_score", F.round(score, 2).cast("decimal(5,2)")).select(
        "driver_id", "safe_driver_score", risk_category(F.col("safe_driver_score")).alias("risk_category"),
        *_DETAIL,
    )


def predict_accident_probability(training: DataFrame, coefficients: list[float] | DataFrame) -> DataFrame:
    """Add ``accident_probability`` from an intercept and one coefficient per model feature.

    Coefficients are numbers, or a one-row table with an array column ``coef``. A driver
    with a NULL feature has no probability.
    """
    if isinstance(coefficients, DataFrame):
        coef = coefficients.select("coef").scalar()
        rows, weight = training.withColumn("_coef", coef), lambda i: F.get(F.col("_coef"), i)
    else:
        rows, weight = training, lambda i: F.lit(float(coefficients[i]))
    z = weight(0)
    for i, name in enumerate(MODEL_FEATURES, start=1):
        z = z + weight(i) * F.col(name).cast("double")
    return rows.withColumn("accident_probability", 1 / (1 + F.exp(-z))).drop("_coef")


def score_logistic(training: DataFrame, coefficients: list[float] | DataFrame) -> DataFrame:
    """Score ``100 * (1 - p)`` from the accident probability, with its risk category."""
    safe = F.round(exact(100 * (1 - F.col("accident_probability"))), 2).cast("decimal(5,2)")
    return (
        predict_accident_probability(training, coefficients)
        .withColumn("safe_driver_score", safe)
        .select("driver_id", "accident_probability", "safe_driver_score",
                risk_category(F.col("safe_driver_score")).alias("risk_category"), *_DETAIL)
    )


def score_composite(training: DataFrame) -> DataFrame:
    """Composite of five 0-100 component scores, clamped to 0-100.

    The category is taken from the sum before clamping.
    """
    whole = _d("100")
    parts = training.withColumns({
        "speed_score": _at_least_zero(whole - (whole - F.col("speed_compliance_rate")) * _d("2")),
        "smoothness_score": _at_least_zero(whole - (F.col("avg_g_force") - _d("1.0")) * _d("50")),
        "harsh_driving_score": _at_least_zero(
            whole - F.col("harsh_driving_events").cast("decimal(12,0)") * _d("2")),
        "distraction_score": _at_least_zero(whole - F.col("phone_usage_rate") * _d("3")),
        "accident_score": _at_least_zero(whole - F.col("accident_count").cast("decimal(12,0)") * _d("20")),
    })
    total = (
        F.col("speed_score") * _d("0.4") + F.col("smoothness_score") * _d("0.15")
        + F.col("harsh_driving_score") * _d("0.15") + F.col("distraction_score") * _d("0.2")
        + F.col("accident_score") * _d("0.1")
    )
    clamped = F.greatest(_d("0"), F.least(whole, total))
    return parts.select(
        "driver_id", "speed_score", "smoothness_score", "harsh_driving_score", "distraction_score",
        "accident_score",
        F.round(clamped, 2).cast("decimal(5,2)").alias("safe_driver_score"),
        band(F.round(total, 2), COMPOSITE_BANDS, "HIGH_RISK").alias("risk_category"),
        *_DETAIL,
    )


def latest_scores(history: DataFrame) -> DataFrame:
    """Each driver's latest row; a tie goes to the larger score id.

    Keeping only rank 1 lets Spark cut every task's rows to one per driver before the
    shuffle, so a driver with a long history does not fill one task.
    """
    latest_first = Window.partitionBy("driver_id").orderBy(
        F.col("calculation_date").desc_nulls_last(), F.col("score_id").desc_nulls_last()
    )
    return history.withColumn("_rank", F.row_number().over(latest_first)).where(F.col("_rank") == 1).drop("_rank")


def current_scores(history: DataFrame) -> DataFrame:
    """Each driver's latest score with its category."""
    return latest_scores(history).select(
        "driver_id", "score", "calculation_date", "notes", risk_category(F.col("score")).alias("risk_category"))


def score_history(history: DataFrame) -> DataFrame:
    """Dated scores per driver with the change since the previous one.

    The previous score is looked up within the same day; the first score of a day takes
    the last one of the driver's previous day with scores. No task therefore sorts more
    than one driver-day, or one row per day of a driver.
    """
    order = (F.col("calculation_date"), F.col("score_id"))
    dated = history.withColumn("_day", F.to_date("calculation_date"))
    within = Window.partitionBy("driver_id", "_day").orderBy(*order)
    by_day = (
        dated.groupBy("driver_id", "_day")
        .agg(F.max_by("score", F.struct(*order)).alias("_last"))
        .withColumn("_carried", F.lag("_last").over(Window.partitionBy("driver_id").orderBy("_day")))
        .select("driver_id", "_day", "_carried")
    )
    previous = F.coalesce(F.lag("score").over(within), F.col("_carried"))
    return (
        dated.join(by_day, ["driver_id", "_day"])
        .withColumn("previous_score", previous)
        .select("driver_id", "score_id", "calculation_date", "score", "previous_score",
                (F.col("score") - F.col("previous_score")).alias("change"))
    )


def _in_band(column: str, label: str) -> Column:
    return F.count_if(F.col(column) == label)


def recalculation_summary(scored: DataFrame) -> DataFrame:
    """One row on a scoring run: number, average, range and drivers per category."""
    score = F.col("safe_driver_score")
    return scored.agg(
        F.count(F.lit(1)).alias("drivers_scored"),
        F.round(F.avg(score), 2).cast("decimal(5,2)").alias("avg_score"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
        _in_band("risk_category", "EXCELLENT").alias("excellent_drivers"),
        _in_band("risk_category", "GOOD").alias("good_drivers"),
        _in_band("risk_category", "AVERAGE").alias("average_drivers"),
        _in_band("risk_category", "POOR").alias("poor_drivers"),
        _in_band("risk_category", "HIGH_RISK").alias("high_risk_drivers"),
    ).select(F.lit("RECALCULATION SUMMARY").alias("summary_type"), "*")


def score_distribution(current: DataFrame) -> DataFrame:
    """Drivers per score band and the same as one line of text."""
    counted = current.agg(
        F.count(F.lit(1)).alias("total"),
        _in_band("risk_category", "EXCELLENT").alias("excellent"),
        _in_band("risk_category", "GOOD").alias("good"),
        _in_band("risk_category", "AVERAGE").alias("average"),
        _in_band("risk_category", "POOR").alias("poor"),
        F.count_if(F.col("score") < HIGH_RISK_BELOW).alias("high_risk"),
    )
    line = F.format_string(
        "Total: %d | Excellent: %d | Good: %d | Average: %d | Poor: %d | High-Risk: %d",
        "total", "excellent", "good", "average", "poor", "high_risk",
    )
    return counted.withColumn("line", line)


def refresh_statistics(current: DataFrame) -> DataFrame:
    """Short form of the distribution, printed after a refresh."""
    return current.agg(
        F.count(F.lit(1)).alias("total_drivers"),
        F.round(F.avg("score"), 2).cast("decimal(5,2)").alias("avg_score"),
        F.count_if(F.col("score") >= 90).alias("excellent_count"),
        F.count_if(F.col("score") < HIGH_RISK_BELOW).alias("high_risk_count"),
    )


def high_risk_drivers(current: DataFrame, below: float = HIGH_RISK_BELOW) -> DataFrame:
    """Drivers whose current score is below the limit."""
    return current.where(F.col("score") < below)


def high_risk_alert(current: DataFrame, below: float = HIGH_RISK_BELOW) -> DataFrame:
    """The alert message: number and comma-separated ids of all high-risk drivers, one line.

    The line is as long as the list. :func:`high_risk_drivers` has the same drivers as rows,
    for fleets whose list is too long for a message.
    """
    return high_risk_drivers(current, below).agg(
        F.count(F.lit(1)).alias("drivers"),
        F.expr("listagg(cast(driver_id as string), ',') within group (order by driver_id)")
        .alias("driver_ids"),
    )


def alerts(scored: DataFrame, rules=ALERT_RULES) -> DataFrame:
    """One row per driver and rule that applies."""
    raised = []
    for condition, trigger, severity, message, action in rules:
        before, after = message.split("{driver_id}")
        raised.append(F.when(F.expr(condition), F.struct(
            F.lit(trigger).alias("trigger"), F.lit(severity).alias("severity"),
            F.concat(F.lit(before), F.col("driver_id").cast("string"), F.lit(after)).alias("message"),
            F.lit(action).alias("action"),
        )))
    return (
        scored.select("driver_id", F.explode(F.array_compact(F.array(*raised))).alias("alert"))
        .select("driver_id", "alert.*")
    )
