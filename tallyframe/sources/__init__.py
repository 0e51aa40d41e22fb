"""Reading, writing and describing tables."""

from tallyframe.sources.scratch import scratch_path, staged, use_checkpoint_dir
from tallyframe.sources.tables import (
    preview,
    read_folds,
    read_table,
    schema_rows,
    table_sizes,
    write_folds,
    write_table,
)

__all__ = [
    "preview",
    "read_folds",
    "read_table",
    "schema_rows",
    "scratch_path",
    "staged",
    "table_sizes",
    "use_checkpoint_dir",
    "write_folds",
    "write_table",
]
