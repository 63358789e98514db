"""Running sums in a total order, without a window over all rows.

The rows are cut into ranges of the order, each range sums its own rows, and
the sums of the ranges before are added. The number of ranges follows the
number of rows, so a task's range stays of one size however large the table
is; only one row per range meets in a single window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreflow.session import scratch_path

# Rows that one range holds on average.
ROWS_PER_RANGE = 1 << 20
PLACE, RANGE = "__place", "__range"


def sorted_ranges(df: DataFrame, order: Sequence[Column | str], rows: int, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """`df` range-sorted and written, with its range and its place in the order."""
    ranges = max(1, -(-rows // rows_per_range))
    place = F.monotonically_increasing_id()
    placed = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn(PLACE, place)
    path = scratch_path(df.sparkSession, "ranges")
    placed.write.parquet(path)
    stored = df.sparkSession.read.schema(placed.schema).parquet(path)
    return stored.withColumn(RANGE, F.shiftright(PLACE, 33))


def prefix_sums(
    df: DataFrame,
    order: Sequence[Column | str],
    values: Sequence[str],
    by: Sequence[str] = (),
    rows_per_range: int = ROWS_PER_RANGE,
    rows: int | None = None,
) -> DataFrame:
    """`df` with ``before_<value>``: the sum of each of `values` over the rows
    of the same `by` (none: over all rows) that come before in `order`, 0 for
    the first. `by` may hold nulls (one group). Rows that are equal in `order`
    are summed in some fixed order. `df` is read several times: pass a written
    table, and its number of `rows` if it is known."""
    rows = df.count() if rows is None else rows
    until = (Window.unboundedPreceding, -1)
    summed = [(v, f"before_{v}") for v in values]
    if rows <= rows_per_range:
        window = Window.partitionBy(*(list(by) or [F.lit(0)])).orderBy(*order).rowsBetween(*until)
        return df.select("*", *[F.coalesce(F.sum(v).over(window), F.lit(0)).alias(b) for v, b in summed])
    placed = sorted_ranges(df, [*by, *order], rows, rows_per_range)
    # One row per range (and group that it holds).
    totals = placed.groupBy(*by, RANGE).agg(*[F.sum(v).alias(f"__{b}") for v, b in summed])
    earlier = Window.partitionBy(*(list(by) or [F.lit(0)])).orderBy(RANGE).rowsBetween(*until)
    offsets = totals.select(
        F.col(RANGE).alias("__r"),
        *[F.col(c).alias(f"__g{i}") for i, c in enumerate(by)],
        *[F.coalesce(F.sum(f"__{b}").over(earlier), F.lit(0)).alias(f"__{b}") for _, b in summed],
    )
    within = Window.partitionBy(*by, RANGE).orderBy(PLACE).rowsBetween(*until)
    inner = placed.select("*", *[F.coalesce(F.sum(v).over(within), F.lit(0)).alias(b) for v, b in summed])
    same = F.col(RANGE) == F.col("__r")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__g{i}"))
    return inner.join(offsets, same).select(*df.columns, *[(F.col(b) + F.col(f"__{b}")).alias(b) for _, b in summed])
