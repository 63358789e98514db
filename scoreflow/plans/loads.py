"""Loads between a database and the date-partitioned lake.

``db_to_lake``: JDBC query (S4, optionally partitioned) → date folder
(K1) with a load report (K9).

``lake_to_db``: SQL file over catalog tables (S3 / B8) → optional
pre-load statements (K3) → JDBC table (K2), or an atomic slice replace
(K4) when ``slice_column`` is given.

Neither persists the whole load to count it: the row count is observed
during the write.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from scoreflow.sinks.jdbc import Statement, replace_slice_jdbc, run_statements, write_jdbc
from scoreflow.sinks.lake import PARTITION_COL, LoadReport, write_date_partition
from scoreflow.sources.jdbc import JdbcConfig, JdbcPartitioning, JdbcPredicates, jdbc_query_scan
from scoreflow.sources.sql_files import run_sql_file


def db_to_lake(
    spark: SparkSession,
    config: JdbcConfig,
    query: str,
    base_path: str,
    data_dt: str,
    mode: str,
    partitioning: JdbcPartitioning | JdbcPredicates | None = None,
    is_dryrun: bool = False,
    partition_col: str = PARTITION_COL,
) -> LoadReport:
    df = jdbc_query_scan(spark, config, query, partitioning)
    return write_date_partition(df, base_path, data_dt, mode, partition_col, is_dryrun=is_dryrun)


def frame_to_lake(
    df: DataFrame,
    base_path: str,
    data_dt: str,
    mode: str,
    is_dryrun: bool = False,
    target_name: str | None = None,
    partition_col: str = PARTITION_COL,
) -> LoadReport:
    """The lake half of ``db_to_lake`` for any source frame."""
    return write_date_partition(df, base_path, data_dt, mode, partition_col, is_dryrun=is_dryrun, target_name=target_name)


def lake_to_db(
    spark: SparkSession,
    sql_file: str,
    params: dict[str, Any],
    config: JdbcConfig,
    table: str,
    mode: str,
    *,
    num_partitions: int,
    pre_statements: Sequence[Statement] = (),
    batchsize: int = 10_000,
    slice_column: str | None = None,
    slice_value: Any = None,
    staging_table: str | None = None,
    is_dryrun: bool = False,
) -> LoadReport:
    df = run_sql_file(spark, sql_file, **params)
    if slice_column is not None:
        if staging_table is None or slice_value is None:
            raise ValueError("an atomic slice replace needs a slice value and a staging table")
        return replace_slice_jdbc(
            spark, df, config, table, slice_column, slice_value, staging_table,
            batchsize=batchsize, num_partitions=num_partitions, is_dryrun=is_dryrun,
        )
    run_statements(spark, config, pre_statements, is_dryrun)
    return write_jdbc(df, config, table, mode, num_partitions=num_partitions, batchsize=batchsize, is_dryrun=is_dryrun)
