"""Readers: bronze JSON documents, Parquet tables, catalog views."""

from .bronze import (
    read_bronze,
    read_day,
    read_documents,
    read_files,
    skipped_documents,
    with_ingest_day,
)
from .catalog import (
    attach,
    column_list,
    discover,
    discover_all,
    evolve,
    query,
    register,
    schema_changes,
)
from .tables import current_lookup, read_table

__all__ = [
    "attach",
    "column_list",
    "current_lookup",
    "discover",
    "discover_all",
    "evolve",
    "query",
    "read_bronze",
    "read_day",
    "read_documents",
    "read_files",
    "read_table",
    "register",
    "schema_changes",
    "skipped_documents",
    "with_ingest_day",
]
