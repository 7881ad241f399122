"""Reading result trees, fixed-width records, job logs and CSV tables; writing results."""

from .files import ca_values, list_files, outcome_listing, quality_of, quality_table, read_ca_values, read_csv_by_name, read_log_lines, skipped_files, tree_stats
from .sinks import copy_csv, preview, write_csv, write_matrix, write_text

__all__ = [
    "ca_values",
    "copy_csv",
    "list_files",
    "outcome_listing",
    "preview",
    "quality_of",
    "quality_table",
    "read_ca_values",
    "read_csv_by_name",
    "read_log_lines",
    "skipped_files",
    "tree_stats",
    "write_csv",
    "write_matrix",
    "write_text",
]
