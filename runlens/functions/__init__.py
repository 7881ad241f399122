"""Column and schema functions."""

from .columns import (
    chain_key,
    default_column,
    last_segment,
    nan_to_null,
    project_keep,
    ratio,
    require_columns,
    status_flags,
    strip,
    threshold_flags,
    where_if_present,
)
from .paths import LOOSE, STRICT, chain_from_name, loose_key, relaxed_sibling, strict_key

__all__ = [
    "LOOSE",
    "STRICT",
    "chain_from_name",
    "chain_key",
    "default_column",
    "last_segment",
    "loose_key",
    "nan_to_null",
    "project_keep",
    "ratio",
    "relaxed_sibling",
    "require_columns",
    "status_flags",
    "strict_key",
    "strip",
    "threshold_flags",
    "where_if_present",
]
