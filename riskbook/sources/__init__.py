"""Sources and sinks: named Parquet tables, the shared folder, fixtures."""

from riskbook.sources.tables import read_table, write_table

__all__ = ["read_table", "write_table"]
