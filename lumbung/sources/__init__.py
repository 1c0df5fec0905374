from lumbung.sources.readers import (
    SqlDump,
    TableSource,
    csv_to_documents,
    empty_table,
    literal_table,
    read_sql_dump,
    read_table,
)
from lumbung.sources.stores import JdbcStore, LoadResult, ParquetStore, jdbc_column_types, shared_folder

__all__ = [
    "JdbcStore",
    "LoadResult",
    "ParquetStore",
    "SqlDump",
    "TableSource",
    "csv_to_documents",
    "empty_table",
    "jdbc_column_types",
    "literal_table",
    "read_sql_dump",
    "read_table",
    "shared_folder",
]
