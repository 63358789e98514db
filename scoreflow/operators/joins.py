"""Join helpers.

A side is broadcast only after its size is checked: we count at most
``max_rows + 1`` rows (a cheap, early-stopping job on a dimension table) and
hint ``broadcast`` only when the side is under the bound. Otherwise the join
is left to Catalyst and AQE (sort-merge with skew splitting, or a runtime
switch to broadcast when the real map output turns out small).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_ROWS = 100_000


def row_count_at_most(df: DataFrame, max_rows: int) -> int | None:
    """Number of rows if it is ``<= max_rows``, else None."""
    n = df.limit(max_rows + 1).count()
    return n if n <= max_rows else None


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if row_count_at_most(df, max_rows) is not None else df


# A key that holds more than one row in so many is hot: there are fewer of
# them than this, however large the table.
HOT_SHARE = 1000


def join_hot_split(rows: DataFrame, facts: DataFrame, keys: Sequence[str], copies: str, total: int) -> DataFrame:
    """`rows` with the other columns of `facts`, which holds every key of
    `rows` once and in `copies` its number of rows, `total` for all keys (NULL
    is a key like any other). Hot keys are looked up in a broadcast of fewer
    than HOT_SHARE facts, so their rows stay where they are; the rest shuffle."""
    added = [c for c in facts.columns if c not in (*keys, copies)]
    is_hot = F.col(copies) * HOT_SHARE > total

    def known(side: DataFrame) -> DataFrame:
        return side.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *added, F.lit(True).alias("__known"))

    def same() -> Column:
        out = F.lit(True)
        for i, k in enumerate(keys):
            out = out & F.col(k).eqNullSafe(F.col(f"__k{i}"))
        return out

    looked = rows.join(F.broadcast(known(facts.where(is_hot))), same(), "left")
    common = looked.where("__known").select(*rows.columns, *added)
    rare = looked.where("__known IS NULL").select(*rows.columns)
    return common.unionByName(rare.join(known(facts.where(~is_hot)), same()).select(*rows.columns, *added))
