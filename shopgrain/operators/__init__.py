"""Table operators the plans are composed of."""

from .arrays import explode_items, nest_items
from .counting import histogram, share_of_total, table_counts, value_counts
from .dedup import latest_per_key
from .grouping import group_totals
from .history import merge_history, open_versions, surrogate_key, valid_on
from .joins import lookup, match, unmatched
from .keys import assign_keys, numbered
from .quality import (
    NotNull,
    Range,
    RowCount,
    Unique,
    ValueSet,
    alert_report,
    check,
    summarize,
    verdict,
)
from .ranking import dense_rank, dense_ranks, exact_quantiles, running_total

__all__ = [
    "NotNull",
    "Range",
    "RowCount",
    "Unique",
    "ValueSet",
    "alert_report",
    "assign_keys",
    "check",
    "dense_rank",
    "dense_ranks",
    "exact_quantiles",
    "explode_items",
    "group_totals",
    "histogram",
    "latest_per_key",
    "lookup",
    "match",
    "merge_history",
    "nest_items",
    "numbered",
    "open_versions",
    "running_total",
    "share_of_total",
    "summarize",
    "surrogate_key",
    "table_counts",
    "unmatched",
    "valid_on",
    "value_counts",
    "verdict",
]
