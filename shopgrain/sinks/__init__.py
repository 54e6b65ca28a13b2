"""Writers: partitioned Parquet, bronze JSON, CSV export, run summaries."""

from .publish import publish_table, switch_table, write_version
from .writers import (
    export_csv,
    run_summary,
    write_bronze_json,
    write_documents,
    write_events,
    write_table,
)

__all__ = [
    "export_csv",
    "publish_table",
    "run_summary",
    "switch_table",
    "write_bronze_json",
    "write_documents",
    "write_events",
    "write_table",
    "write_version",
]
