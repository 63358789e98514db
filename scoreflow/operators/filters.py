"""Row filters and column choice."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreflow.functions.dates import months_back
from scoreflow.operators.features import CATEGORICAL_COLUMNS, DATE_COLUMN, ID_COLUMN, LABEL_COLUMN

MONTH_COLUMN = "snapshot_month"  # partition column of the written feature store


def filter_recent(
    df: DataFrame,
    months: int,
    as_of: dt.date | str | Column | None = None,
    date_col: str = DATE_COLUMN,
) -> DataFrame:
    """keep ``date_col >= add_months(as_of, -months)``. Inclusive, no
    upper bound, NULL dates drop. With a literal ``as_of`` the cut-off is
    constant-folded and pushed into the Parquet scan. When the frame carries
    the feature store's ``snapshot_month`` partition column, the implied
    ``snapshot_month >= trunc(cut-off, 'MM')`` is added so whole month
    folders are pruned; it removes no row the main predicate keeps."""
    cutoff = months_back(as_of, months)
    cond = F.col(date_col) >= cutoff
    if date_col == DATE_COLUMN and MONTH_COLUMN in df.columns:
        cond = (F.col(MONTH_COLUMN) >= F.trunc(cutoff, "MM")) & cond
    return df.filter(cond)


def drop_unlabelled(df: DataFrame, label_col: str = LABEL_COLUMN) -> DataFrame:
    """drop rows whose label is NULL."""
    return df.dropna(subset=[label_col])


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.BooleanType)


def numeric_feature_columns(
    df: DataFrame,
    exclude: Iterable[str] = (LABEL_COLUMN, DATE_COLUMN, ID_COLUMN, *CATEGORICAL_COLUMNS),
) -> list[str]:
    """every column not excluded, in frame order, restricted to numeric
    and boolean types (a string column would make the assembler fail)."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if f.name not in skip and isinstance(f.dataType, _NUMERIC)]
