from tabml.functions.columns import (
    HASH_SPACE,
    hash_position,
    is_missing,
    missing_to_null,
    named,
    ratio,
    require_columns,
    row_text,
)

__all__ = [
    "HASH_SPACE",
    "hash_position",
    "is_missing",
    "missing_to_null",
    "named",
    "ratio",
    "require_columns",
    "row_text",
]
