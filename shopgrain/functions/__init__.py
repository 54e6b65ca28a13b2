"""Column helpers: plain built-in expressions, no user functions."""

from .columns import (
    calendar_columns,
    clean_text,
    digits_only,
    full_name,
    line_metrics,
    percent,
    ratio,
    run_time,
    to_day,
    to_number,
)
from .scoring import RfmThresholds, customer_tier, rfm_segment, threshold_score

__all__ = [
    "RfmThresholds",
    "calendar_columns",
    "clean_text",
    "customer_tier",
    "digits_only",
    "full_name",
    "line_metrics",
    "percent",
    "ratio",
    "rfm_segment",
    "run_time",
    "threshold_score",
    "to_day",
    "to_number",
]
