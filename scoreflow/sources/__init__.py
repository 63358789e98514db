"""Scans: every function returns a lazy DataFrame so Catalyst can push
filters and projections into the scan."""

from scoreflow.sources.parquet import load_table, load_tables, read_feature_store, read_merged
from scoreflow.sources.sql_files import bind_sql_file, read_sql_file, run_sql_file
from scoreflow.sources.jdbc import JdbcConfig, jdbc_query_scan, jdbc_table_scan
from scoreflow.sources.tables import table_scan

__all__ = [
    "JdbcConfig",
    "bind_sql_file",
    "jdbc_query_scan",
    "jdbc_table_scan",
    "load_table",
    "load_tables",
    "read_feature_store",
    "read_merged",
    "read_sql_file",
    "run_sql_file",
    "table_scan",
]
