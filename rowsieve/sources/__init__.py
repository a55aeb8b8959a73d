"""Sources (S1–S6) and sinks (K1–K2)."""

from rowsieve.sources.readers import (
    read_csv,
    read_parquet,
    read_table,
    register_view,
    schema_from_json,
)
from rowsieve.sources.sinks import (
    save_good,
    save_rejected,
    save_rejected_with_stats,
    timestamped_path,
    write_parquet,
    write_split,
)

__all__ = [
    "read_csv",
    "read_parquet",
    "read_table",
    "register_view",
    "save_good",
    "save_rejected",
    "save_rejected_with_stats",
    "schema_from_json",
    "timestamped_path",
    "write_parquet",
    "write_split",
]
