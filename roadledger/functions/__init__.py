"""Column expressions shared by the operators."""

from .exact import as_percent, exact, rounded
from .keys import geo_zone, policy_key
from .labels import (
    customer_name,
    logistic_notes,
    response_priority,
    risk_category,
    vehicle_description,
    weighted_notes,
)
from .moments import (
    day_of,
    event_ts,
    instant,
    minutes_since,
    sunday_zero_weekday,
    time_category,
)
from .motion import g_of, severity_level, with_forces

__all__ = [
    "as_percent", "customer_name", "day_of", "event_ts", "exact", "g_of", "geo_zone", "instant",
    "logistic_notes", "minutes_since", "policy_key", "response_priority", "risk_category",
    "rounded", "severity_level", "sunday_zero_weekday", "time_category", "vehicle_description",
    "weighted_notes", "with_forces",
]
