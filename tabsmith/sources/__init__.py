"""Sources and sinks."""

from tabsmith.sources.records import (
    mappings_document,
    read_mappings,
    read_run_record,
    write_mappings,
    write_mappings_document,
    write_run_record,
)
from tabsmith.sources.tables import (
    discover, table_sizes,
    infer_types,
    peek_columns,
    pool,
    read_table,
    scratch_path,
    write_table,
)

__all__ = ["discover", "table_sizes", "infer_types", "peek_columns", "pool", "read_table", "scratch_path",
           "write_table", "write_mappings", "read_mappings", "mappings_document",
           "write_mappings_document",
           "write_run_record", "read_run_record"]
