"""Convert every column of a frame to text in one projection.

Rules (parameters default to the reference's patterns):

* strings stay as they are;
* decimal, double and float go through ``format_number(x, pattern)``: the
  shortest digits, no grouping, no trailing ``.0``;
* dates use ``date_fmt``; timestamps, with or without time zone, use
  ``timestamp_fmt`` (the reference misses ``timestamp_ntz`` and casts it,
  keeping fractional seconds; ``ntz_as_timestamp=False`` restores that);
* everything else is ``CAST(x AS STRING)``.

All columns are converted in a single ``select`` with back-quoted names, so
odd names (spaces, dots) are safe and the plan has one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The reference's default text patterns.
DATE_FMT = "yyyy-MM-dd"
TIMESTAMP_FMT = "yyyy-MM-dd HH:mm:ss"
NUMBER_FMT = "#.####################"


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def to_text_column(
    column: Column,
    dtype: T.DataType,
    date_fmt: str = DATE_FMT,
    timestamp_fmt: str = TIMESTAMP_FMT,
    number_fmt: str = NUMBER_FMT,
    ntz_as_timestamp: bool = True,
) -> Column:
    if isinstance(dtype, T.StringType):
        return column
    if isinstance(dtype, (T.DecimalType, T.DoubleType, T.FloatType)):
        return F.call_function("format_number", column, F.lit(number_fmt))
    if isinstance(dtype, T.DateType):
        return F.date_format(column, date_fmt)
    if isinstance(dtype, T.TimestampType) or (ntz_as_timestamp and isinstance(dtype, T.TimestampNTZType)):
        return F.date_format(column, timestamp_fmt)
    return column.cast("string")


def to_text_columns(
    df: DataFrame,
    date_fmt: str = DATE_FMT,
    timestamp_fmt: str = TIMESTAMP_FMT,
    number_fmt: str = NUMBER_FMT,
    ntz_as_timestamp: bool = True,
) -> DataFrame:
    return df.select(
        *[
            to_text_column(quoted(f.name), f.dataType, date_fmt, timestamp_fmt, number_fmt, ntz_as_timestamp).alias(f.name)
            for f in df.schema.fields
        ]
    )
