"""Lake sinks: date-partitioned writes (K1), slice replace (K4, lake side),
load reports and dry runs (K9), daily exports (K8).

Layout: ``<base>/<PARTITION_COL>=<YYYYMMDD>/part-*.parquet``. A load knows its
date, so it writes that one folder: an overwrite replaces it, with no rows as
well as with many, and other dates survive — a re-run of one day is idempotent.

The load report counts rows with ``DataFrame.observe`` during the write: the
reference persisted the frame, counted it, then wrote it (two passes and a
cache of the whole load); here the count is a by-product of the single
write pass.
"""

from __future__ import annotations

import logging
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("scoreflow.load")

PARTITION_COL = "DATA_DT"
REPORT_SCHEMA = "target string, mode string, rows bigint, is_dryrun boolean"


@dataclass(frozen=True)
class LoadReport:
    target: str
    mode: str
    rows: int
    is_dryrun: bool

    def log(self) -> "LoadReport":
        verb = "would write" if self.is_dryrun else "wrote"
        log.info("%s %s rows to %s (%s)", verb, f"{self.rows:,}", self.target, self.mode)
        return self

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(self.target, self.mode, self.rows, self.is_dryrun)], REPORT_SCHEMA)


def _check_mode(mode: str) -> str:
    if mode not in ("overwrite", "append"):
        raise ValueError(f"write mode must be overwrite or append, not {mode!r}")
    return mode


def observed_counts(df: DataFrame, write, name: str = "load", **counts: Column) -> dict[str, int]:
    """Run ``write(observed_df)`` and return the number of rows written and,
    by name, the further ``counts`` taken of them in the same pass."""
    # A unique name: Spark rejects two observations of one name in a plan.
    obs = Observation(f"{name}_{uuid.uuid4().hex[:8]}")
    write(df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in counts.items()]))
    return {k: int(obs.get.get(k) or 0) for k in ("rows", *counts)}


def write_observed(df: DataFrame, write, name: str = "load") -> int:
    """Run ``write(observed_df)`` and return the number of rows written."""
    return observed_counts(df, write, name)["rows"]


def date_folder(base_path: str, data_dt: str, partition_col: str = PARTITION_COL) -> str:
    """The folder of one date. Only names that need no escaping are taken."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", str(data_dt)):
        raise ValueError(f"not a partition value: {data_dt!r}")
    return f"{base_path.rstrip('/')}/{partition_col}={data_dt}"


def write_date_partition(
    df: DataFrame,
    base_path: str,
    data_dt: str,
    mode: str,
    partition_col: str = PARTITION_COL,
    fmt: str = "parquet",
    is_dryrun: bool = False,
    target_name: str | None = None,
    options: dict[str, str] | None = None,
) -> LoadReport:
    """K1 + K9: write ``df`` as the ``data_dt`` folder of ``base_path``.

    ``overwrite`` replaces that date only; ``append`` adds files to it. A dry
    run counts the rows and writes nothing."""
    _check_mode(mode)
    target = target_name or base_path
    if is_dryrun:
        return LoadReport(target, mode, df.count(), True).log()
    # A column named like the partition column would be shadowed by the
    # folder value on read; the folder value is the one that is kept.
    clash = [c for c in df.columns if c.lower() == partition_col.lower()]
    folder = date_folder(base_path, data_dt, partition_col)

    def _write(frame: DataFrame) -> None:
        frame.write.format(fmt).options(**(options or {})).mode(mode).save(folder)

    rows = write_observed(df.drop(*clash), _write)
    return LoadReport(target, mode, rows, False).log()


def read_date_partitioned(
    spark: SparkSession,
    base_path: str,
    partition_col: str = PARTITION_COL,
    merge_schema: bool = False,
    fmt: str = "parquet",
    out_col: str = "data_dt",
) -> DataFrame:
    """Read a date-partitioned folder with the partition value as text in
    ``out_col``. Filters on it are still partition filters (folder pruning)."""
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    df = reader.load(base_path)
    cols = [F.col(f"`{c}`") for c in df.columns if c.lower() != partition_col.lower()]
    return df.select(*cols, F.col(partition_col).cast("string").alias(out_col))
