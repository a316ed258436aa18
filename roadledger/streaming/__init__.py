"""Structured Streaming jobs that reuse the batch operators."""

from .jobs import (
    feature_windows,
    merged_windows,
    stream_features,
    stream_high_gforce,
    stream_scores,
)

__all__ = ["feature_windows", "merged_windows", "stream_features",
           "stream_high_gforce", "stream_scores"]
