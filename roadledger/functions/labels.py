"""Labels and texts written to reports and to the score history."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score bands (inclusive lower edges) of the current-score views.
SCORE_BANDS = ((90, "EXCELLENT"), (80, "GOOD"), (70, "AVERAGE"), (60, "POOR"))
LOWEST_BAND = "HIGH_RISK"

# Response priorities from most to least urgent.
RESPONSE_LABELS = ("IMMEDIATE_RESPONSE", "URGENT_RESPONSE", "STANDARD_RESPONSE", "LOW_PRIORITY")


def band(score: Column, bands, lowest: str) -> Column:
    (edge, label), *rest = bands
    out = F.when(score >= edge, label)
    for edge, label in rest:
        out = out.when(score >= edge, label)
    return out.otherwise(lowest)


def risk_category(score: Column) -> Column:
    return band(score, SCORE_BANDS, LOWEST_BAND)


def response_priority(as_rank: bool = False) -> Column:
    """Urgency of a crash from ``emergency_recommended`` and ``risk_score``."""
    urgent, risk = F.col("emergency_recommended"), F.col("risk_score")
    first, second, third, last = (1, 2, 3, 4) if as_rank else RESPONSE_LABELS
    return (
        F.when(urgent & (risk >= 90), first)
        .when(urgent & (risk >= 70), second)
        .when(risk >= 50, third)
        .otherwise(last)
    )


def customer_name(first: str = "first_name", last: str = "last_name") -> Column:
    """Full name; NULL if either part is NULL."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def vehicle_description(make: str = "make", model: str = "model", year: str = "vehicle_year") -> Column:
    """``make model (year)``; NULL if any part is NULL."""
    return F.concat(
        F.col(make), F.lit(" "), F.col(model), F.lit(" ("), F.col(year).cast("string"), F.lit(")")
    )


def _joined(*parts) -> Column:
    """Concatenation in which a NULL part counts as empty text."""
    return F.concat_ws("", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def weighted_notes() -> Column:
    """History note of a score from the weighted formula (fixed wording)."""
    return _joined(
        "Risk: ", F.col("risk_category"),
        " | Accidents: ", F.col("accident_count"), " (25%)",
        " | Speed: ", F.col("speed_compliance_rate"), "% (30%)",
        " | Phone: ", F.col("phone_usage_rate"), "% (20%)",
        " | Harsh: ", F.col("harsh_driving_events"), " (15%)",
        " | Model: Weighted Formula v4",
    )


def logistic_notes(retrained: bool = False) -> Column:
    """History note of a score from the accident model.

    The wording, model name included, is fixed: readers of the history parse it.
    """
    model_name = "MADlib Logistic Regression" + (" (Retrained)" if retrained else "")
    return _joined(
        "ML Risk Category: ", F.col("risk_category"),
        " | Speed Compliance: ", F.col("speed_compliance_rate"), "%",
        " | Harsh Events: ", F.col("harsh_driving_events"),
        " | Phone Usage: ", F.col("phone_usage_rate"), "%",
        " | Accidents: ", F.col("accident_count"),
        f" | Model: {model_name}",
    )
