from tablefit.sources.schema import (
    cast_like,
    column_roles,
    numeric_columns,
    rename_strict,
    schema_frame,
    suffixed,
)
from tablefit.sources.standins import blocks, clients
from tablefit.sources.tables import TABLES, load, read_table, spread, spread_rows, table_path, write_csv

__all__ = [
    "TABLES",
    "blocks",
    "cast_like",
    "clients",
    "column_roles",
    "load",
    "numeric_columns",
    "read_table",
    "rename_strict",
    "schema_frame",
    "spread",
    "spread_rows",
    "suffixed",
    "table_path",
    "write_csv",
]
