from tabml.sources.staging import drop_stages, release, shared_dir, spread, stage
from tabml.sources.tables import (
    column_types,
    load_table,
    read_csv,
    read_csv_checked,
    register_view,
    write_csv,
)
from tabml.sources.views import blocks, docs, lines

__all__ = [
    "blocks",
    "column_types",
    "docs",
    "drop_stages",
    "lines",
    "load_table",
    "read_csv",
    "read_csv_checked",
    "register_view",
    "release",
    "shared_dir",
    "spread",
    "stage",
    "write_csv",
]
