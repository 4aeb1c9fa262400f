"""Sources and sinks."""

from starload.sources.bucketed import declare_bucketed, write_bucketed
from starload.sources.files import (
    append_table,
    create_table,
    overwrite_table,
    read_csv,
    read_parquet,
    readback_content,
    readback_count,
    split_rejects,
    table_checksum,
    write_csv,
)
from starload.sources.jdbc import max_key_query, read_jdbc, read_jdbc_query, write_jdbc

__all__ = [
    "append_table",
    "create_table",
    "declare_bucketed",
    "max_key_query",
    "overwrite_table",
    "read_csv",
    "read_jdbc",
    "read_jdbc_query",
    "read_parquet",
    "readback_content",
    "readback_count",
    "split_rejects",
    "table_checksum",
    "write_bucketed",
    "write_csv",
    "write_jdbc",
]
