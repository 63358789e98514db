"""Daily snapshot export.

The reference reads a response view, keeps the rows of the previous local
day (a fixed zone, ``LOCAL_ZONE``) relative to the job's UTC trigger time, collects them to
the driver with ``toPandas`` and uploads a spreadsheet. Here the rows are
filtered at the scan (typed literal bounds → pushed filters), converted to
text in one projection (F6) and written by the executors as the
``EXPORT_DT=<yyyymmdd>`` folder of the export root (a name of its own, so a
``data_dt`` column of the exported rows is kept as data) — nothing passes through
the driver, and a re-run of the day replaces just that folder.

A text file whose fields may hold line ends is read by one task, so files are
cut by their bytes: running sums of the rows' written lengths give every row
its file, and each file is one task of the write.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreflow.functions.dates import LOCAL_ZONE, local_day_window, ts_literal
from scoreflow.functions.textify import to_text_columns
from scoreflow.operators.prefix import prefix_sums
from scoreflow.session import scratch_path
from scoreflow.sinks.lake import LoadReport, date_folder, write_date_partition

# Text export: header row, every field quoted, quotes doubled (RFC 4180). Spaces,
# line ends and empty texts stay as they are; NULL is the sentinel below. A file
# is read whole when fields may hold line ends, so files are kept small.
NULL_TEXT = "\\N"
_CSV = {
    "header": "true",
    "escape": '"',
    "lineSep": "\n",
    "nullValue": NULL_TEXT,
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
EXPORT_OPTIONS = {"csv": {**_CSV, "quoteAll": "true"}}
READ_OPTIONS = {"csv": {**_CSV, "multiLine": "true", "inferSchema": "false"}}
EXPORT_PARTITION = "EXPORT_DT"
FILE_BYTES = 64 << 20


def daily_window(df: DataFrame, trigger: str | dt.datetime, tz: str = LOCAL_ZONE, ts_col: str = "load_dt") -> tuple[DataFrame, str]:
    """the rows of the previous local day and that day as ``YYYYMMDD``."""
    start, end, data_dt = local_day_window(trigger, tz)
    dtype = df.schema[ts_col].dataType
    window = df.filter((F.col(ts_col) >= ts_literal(start, dtype)) & (F.col(ts_col) < ts_literal(end, dtype)))
    return window, data_dt


def daily_export(
    df: DataFrame,
    export_root: str,
    trigger: str | dt.datetime,
    tz: str = LOCAL_ZONE,
    ts_col: str = "load_dt",
    fmt: str = "csv",
    is_dryrun: bool = False,
    file_bytes: int = FILE_BYTES,
) -> LoadReport:
    window, data_dt = daily_window(df, trigger, tz, ts_col)
    text = to_text_columns(window)
    if fmt == "csv":
        text = protect_null_text(text)
        if not is_dryrun:
            text = in_files(text, file_bytes)
    return write_date_partition(
        text,
        export_root,
        data_dt,
        "overwrite",
        partition_col=EXPORT_PARTITION,
        fmt=fmt,
        is_dryrun=is_dryrun,
        target_name=date_folder(export_root, data_dt, EXPORT_PARTITION),
        options=EXPORT_OPTIONS.get(fmt),
    )


def line_bytes(columns: list[str]) -> Column:
    """The bytes of a row's line: every field quoted, quotes doubled, a
    separator or line end after each."""
    total = F.lit(0).cast("bigint")
    for c in columns:
        text = F.coalesce(F.col(f"`{c}`"), F.lit(NULL_TEXT))
        quotes = F.octet_length(text) - F.octet_length(F.replace(text, F.lit('"')))
        total = total + F.octet_length(text) + quotes + F.lit(3)
    return total


def in_files(text: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``text`` in one partition per file, none of which is written larger than
    ``file_bytes`` (a row larger than that is a file of its own)."""
    header = sum(len(c.encode()) + c.count('"') + 3 for c in text.columns)
    room = file_bytes - header
    if room < 1:
        raise ValueError(f"files of {file_bytes} bytes have no room beside a header of {header}")
    size = text.select(line_bytes(text.columns).alias("b")).agg(F.coalesce(F.sum("b"), F.lit(0))).first()[0]
    if size <= room:
        return text.repartition(1)
    sized = text.withColumn("__bytes", line_bytes(text.columns))
    # Rows of more than half a file get files to themselves; a slot of the
    # others is half a file, and what its last row adds is less than that.
    slot = max(1, room // 2)
    long = F.col("__bytes") > slot
    sized = sized.withColumn("__long", long.cast("int")).withColumn("__short", F.when(long, 0).otherwise(F.col("__bytes")))
    sized = sized.withColumn("__row", F.monotonically_increasing_id())
    path = scratch_path(text.sparkSession, "export_lines")
    sized.write.parquet(path)
    stored = text.sparkSession.read.schema(sized.schema).parquet(path)
    # The running sums take the rows' numbers and lengths alone; the texts meet
    # their files in a join of tasks no larger than a file.
    placed = prefix_sums(stored.select("__row", "__short", "__long"), ["__row"], ["__short", "__long"])
    slots, longs = stored.agg(F.sum("__short"), F.sum("__long")).first()
    slots = -(-slots // slot)
    files = int(slots + longs)
    number = F.when(F.col("__long") == 1, F.lit(slots) + F.col("before___long")).otherwise(F.expr(f"before___short div {slot}"))
    placed = placed.select("__row", number.cast("int").alias("__file"))
    placed = stored.repartition(files, "__row").join(placed, "__row").repartitionById(files, "__file")
    return placed.select(*[F.col(f"`{c}`") for c in text.columns])


def protect_null_text(df: DataFrame) -> DataFrame:
    """Texts that look like the NULL sentinel get one more backslash."""
    looks = lambda c: F.col(c).rlike(r"^\\+N$")
    return df.select(*[F.when(looks(c), F.concat(F.lit("\\"), F.col(c))).otherwise(F.col(c)).alias(c) for c in df.columns])


def restore_null_text(df: DataFrame) -> DataFrame:
    looks = lambda c: F.col(c).rlike(r"^\\\\+N$")
    return df.select(*[F.when(looks(c), F.expr(f"substr(`{c}`, 2)")).otherwise(F.col(c)).alias(c) for c in df.columns])


def read_export(spark, export_root: str, data_dt: str, fmt: str = "csv") -> DataFrame:
    """Read one exported day back (all columns text). A day exported without
    rows has none."""
    folder = date_folder(export_root, data_dt, EXPORT_PARTITION)
    df = spark.read.format(fmt).options(**READ_OPTIONS.get(fmt, {})).load(folder)
    return restore_null_text(df) if fmt == "csv" else df
