"""Files, catalog tables and message sources."""

from strataflow.sources.catalog import (
    append,
    compact,
    create_database,
    create_table,
    create_table_like,
    is_streamed,
    overwrite,
    publish,
    read_table,
    schema_ddl,
    write_batch,
)
from strataflow.sources.files import export_csv, read_csv, scratch_path, use_scratch
from strataflow.sources.messages import kafka_options, read_messages, read_stream, write_messages

__all__ = [
    "append",
    "compact",
    "create_database",
    "create_table",
    "create_table_like",
    "export_csv",
    "is_streamed",
    "kafka_options",
    "overwrite",
    "publish",
    "read_csv",
    "read_messages",
    "read_stream",
    "read_table",
    "schema_ddl",
    "scratch_path",
    "use_scratch",
    "write_batch",
    "write_messages",
]
