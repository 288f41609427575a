"""Export tables and their writers."""

from asiento.sinks.bundle import (
    company_metadata,
    display,
    export_company,
    export_tables,
    statement_metadata,
    statement_values_export,
    write_apart,
    write_bundle,
    write_bundle_apart,
)
from asiento.sinks.merge import last_position, merge_groups, merge_last, read_merged

__all__ = [
    "company_metadata", "display", "export_company", "export_tables", "last_position", "merge_groups", "merge_last", "read_merged", "statement_metadata", "statement_values_export",
    "write_apart", "write_bundle", "write_bundle_apart",
]
