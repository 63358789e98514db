"""Catalog table / view scans with the table format as a parameter.

The reference reads a Delta view by name. The Delta jar is not available
here, so the format is a parameter: a catalog name is read with
``spark.read.table`` whatever its format, and a path is read with the given
format (default Parquet)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_scan(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.read.table(name_or_path)
