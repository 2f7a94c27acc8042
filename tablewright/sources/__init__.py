"""Reading and writing: files, catalog tables, keyed tables."""

from tablewright.sources.files import read_csv_text, read_json_records, read_log
from tablewright.sources.keyed import read_keyed, rebucket_keyed, upsert_keyed
from tablewright.sources.sinks import (
    create_table,
    drop_table,
    insert_select,
    write_collection,
    write_counted,
    write_parquet,
    write_relationalized,
    write_table,
)
from tablewright.sources.tables import read_table, register_log, register_path

__all__ = [
    "create_table", "drop_table", "insert_select", "read_csv_text", "read_json_records", "read_keyed",
    "read_log", "read_table", "register_log", "register_path", "rebucket_keyed", "upsert_keyed", "write_collection",
    "write_counted", "write_parquet", "write_relationalized", "write_table",
]
