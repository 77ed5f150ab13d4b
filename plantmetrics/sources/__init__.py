from plantmetrics.sources.scratch import clear_scratch, scratch_path, scratch_scope, stage
from plantmetrics.sources.tables import (
    export_csv,
    preview,
    read_csv,
    read_days,
    read_json,
    read_table,
    write_bucketed,
    write_counted,
    write_days,
    write_table,
)

__all__ = [
    "clear_scratch",
    "export_csv",
    "preview",
    "read_csv",
    "read_days",
    "read_json",
    "read_table",
    "scratch_path",
    "scratch_scope",
    "stage",
    "write_bucketed",
    "write_counted",
    "write_days",
    "write_table",
]
