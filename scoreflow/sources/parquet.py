"""Parquet scans."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables: ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_tables(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: load_table(spark, sf_dir, name) for name in names}


def read_feature_store(spark: SparkSession, path: str) -> DataFrame:
    """The feature-store scan. A plain Parquet read; filters applied later
    on ``snapshot_date`` reach the scan as ``PushedFilters`` and, when the
    store is partitioned by date, as ``PartitionFilters``."""
    return spark.read.parquet(path)


def read_merged(spark: SparkSession, path: str, base_path: str | None = None) -> DataFrame:
    """Parquet read that unions the footers of all files, so columns that
    only some files carry come back NULL for the others.

    The option is set on this read only; the reference flips the session-wide
    ``spark.sql.parquet.mergeSchema`` flag, which would slow every later scan
    in the session (footer merge on each)."""
    reader = spark.read.option("mergeSchema", "true")
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.parquet(path)
