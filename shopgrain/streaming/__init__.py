"""Incremental loading: run watermarks, file ledger, merges and file streams."""

from .incremental import filter_since, load_available, merge_available, upsert_orders
from .ledger import listed_files, loaded_files, pending_files, record_files
from .logs import append_log, compact_log, read_log
from .merge import delivered_keys, merge_deliveries
from .watermarks import current_watermarks, last_run, record_run

__all__ = [
    "append_log",
    "compact_log",
    "current_watermarks",
    "delivered_keys",
    "filter_since",
    "last_run",
    "listed_files",
    "load_available",
    "loaded_files",
    "merge_available",
    "merge_deliveries",
    "pending_files",
    "read_log",
    "record_files",
    "record_run",
    "upsert_orders",
]
