"""Sources and sinks: raw-table readers, the table sink and the fixture adapter."""

from kpiloom.sources.raw import RAW_SCHEMAS, RawTables, read_raw, read_raw_dir, write_raw_dir
from kpiloom.sources.sink import read_table, replace_table, write_table
from kpiloom.sources.tpch_fixture import derive_raw

__all__ = ["RAW_SCHEMAS", "RawTables", "read_raw", "read_raw_dir", "write_raw_dir",
           "read_table", "replace_table", "write_table", "derive_raw"]
