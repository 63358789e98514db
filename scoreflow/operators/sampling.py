"""Deterministic sampling and splitting.

``orderBy(rand()).limit(n)`` (the reference's negative sampler) is planned as
``TakeOrderedAndProject``: every task sends its best ``n`` rows to one task,
so ``n`` rows meet in one place, and ``rand()`` changes with the partition
layout. ``randomSplit`` has the same layout dependence.

Here every row gets a reproducible draw from md5(seed|key):

* ``hash_split`` compares a [0, 1) draw with the cumulative weights — a
  per-row filter, no shuffle at all;
* ``smallest_by_hash`` returns exactly the ``n`` rows with the smallest
  60-bit order hash. It narrows down the cut with histograms of hash
  prefixes (``groupBy(prefix).count()``: partial aggregation, at most
  2^16 groups reach the driver per round), takes every row below the cut
  with a plain filter, and orders only the rows of the one cut bucket — at
  most ``final_rows`` of them — so no task ever sees more than that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreflow.functions.hashing import ORDER_HASH_BITS, order_hash, unit_hash
from scoreflow.operators.features import ID_COLUMN, LABEL_COLUMN

BUCKET_BITS = 16
FINAL_ROWS = 200_000
_H = "__sf_h"
_H2 = "__sf_h2"


# ---------------------------------------------------------------------------
# L2: split
# ---------------------------------------------------------------------------


def _bounds(weights: Sequence[float]) -> list[float]:
    total = float(sum(weights))
    if total <= 0 or any(w < 0 for w in weights):
        raise ValueError(f"bad split weights {weights}")
    acc, out = 0.0, []
    for w in weights:
        acc += w
        out.append(acc / total)
    return out


def split_label(weights: Sequence[float], names: Sequence[str], seed: int, key: str = ID_COLUMN) -> Column:
    """Name of the part each row falls in (first part whose bound exceeds
    the row's draw)."""
    if len(weights) != len(names):
        raise ValueError("one name per weight")
    u = unit_hash(seed, key)
    bounds = _bounds(weights)
    expr = F.lit(names[-1])
    for bound, name in reversed(list(zip(bounds[:-1], names[:-1]))):
        expr = F.when(u < F.lit(bound), F.lit(name)).otherwise(expr)
    return expr


def hash_split(df: DataFrame, weights: Sequence[float], seed: int, key: str = ID_COLUMN) -> list[DataFrame]:
    """Disjoint parts covering ``df``; the same seed gives the same rows at
    any partition count. Each part is a filter over the same plan."""
    u = unit_hash(seed, key)
    bounds = _bounds(weights)
    parts, lower = [], None
    for i, upper in enumerate(bounds):
        cond = F.lit(True) if lower is None else (u >= F.lit(lower))
        if i < len(bounds) - 1:
            cond = cond & (u < F.lit(upper))
        parts.append(df.filter(cond))
        lower = upper
    return parts


# ---------------------------------------------------------------------------
# L1: exact n smallest by hash
# ---------------------------------------------------------------------------


def _hashable(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.UserDefinedType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_hashable(f.dataType) for f in dtype.fields)
    return True


def _row_hash(df: DataFrame) -> Column:
    # Secondary order: a hash of the row (every column xxhash64 accepts), so
    # rows that share a key are still ordered deterministically.
    cols = [F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)]
    return F.xxhash64(*cols) if cols else F.lit(0).cast("bigint")


def _take_identical(rows: DataFrame, need: int) -> DataFrame:
    """``need`` of ``rows`` without moving them: count rows per input
    partition (one small row per partition reaches the driver), then keep
    whole partitions in order and a prefix of the last one.
    ``monotonically_increasing_id`` carries the partition index in its upper
    bits and the row position within the partition in its lower 33 bits."""
    mid = F.monotonically_increasing_id()
    tagged = rows.withColumn("__sf_p", F.shiftright(mid, 33)).withColumn("__sf_r", mid.bitwiseAND(F.lit((1 << 33) - 1)))
    counts = tagged.groupBy("__sf_p").count().orderBy("__sf_p").collect()
    left, last_p, last_q = need, None, 0
    for r in counts:
        last_p = r["__sf_p"]
        last_q = min(left, r["count"])
        left -= last_q
        if left == 0:
            break
    if last_p is None:
        return rows.limit(0)
    keep = (F.col("__sf_p") < F.lit(last_p)) | ((F.col("__sf_p") == F.lit(last_p)) & (F.col("__sf_r") < F.lit(last_q)))
    return tagged.filter(keep).drop("__sf_p", "__sf_r")


def _levels(bucket_bits: int) -> list[tuple[str, int]]:
    """Digits of the order key, most significant first: (column, shift)."""
    levels: list[tuple[str, int]] = []
    for col, width in ((_H, ORDER_HASH_BITS), (_H2, 64)):
        shift = width
        while shift > 0:
            shift = max(0, shift - bucket_bits)
            levels.append((col, shift))
    return levels


def _smallest(
    hashed: DataFrame,
    among: Column,
    n: int,
    bucket_bits: int,
    final_rows: int,
    hist: list[tuple[int, int]] | None = None,
) -> tuple[Column, DataFrame | None]:
    """The ``n`` rows of ``hashed`` within ``among`` that come first in hash
    order, as a condition for rows taken in place and, where the cut falls
    inside a bucket, a frame of that bucket's share. ``hist`` may carry the
    first histogram ``(digit, count)`` from another pass."""
    take = F.lit(False)
    rest, need = among, n  # rows that share the digits fixed so far
    for col, shift in _levels(bucket_bits):
        digit = F.shiftright(F.col(col), shift)
        if hist is None:
            counted = hashed.filter(rest).groupBy(digit.alias("d")).count().collect()
            hist = [(r["d"], r["count"]) for r in counted]
        cut = None
        for d, count in sorted(hist):
            if count > need:
                cut = (d, count)
                break
            need -= count
        hist = None
        if cut is None:
            return take | rest, None
        take = take | (rest & (digit < F.lit(cut[0])))
        if need == 0:
            return take, None
        rest = rest & (digit == F.lit(cut[0]))
        if cut[1] <= final_rows:
            return take, hashed.filter(rest).orderBy(_H, _H2).limit(need)
    # Only identical rows (same key, same content) are left: any of them will do.
    return take, _take_identical(hashed.filter(rest), need)


def _with_hashes(df: DataFrame, seed: int, key: str) -> DataFrame:
    return df.withColumn(_H, order_hash(seed, key)).withColumn(_H2, _row_hash(df))


def _gather(hashed: DataFrame, take: Column, share: DataFrame | None) -> DataFrame:
    out = hashed.filter(take)
    return (out if share is None else out.unionByName(share)).drop(_H, _H2)


def smallest_by_hash(
    df: DataFrame,
    n: int,
    seed: int,
    key: str = ID_COLUMN,
    bucket_bits: int = BUCKET_BITS,
    final_rows: int = FINAL_ROWS,
) -> DataFrame:
    """Exactly ``min(n, count)`` rows of ``df``: those with the smallest
    ``(order_hash(seed, key), xxhash64(row))``."""
    if n <= 0:
        return df.limit(0)
    hashed = _with_hashes(df, seed, key)
    return _gather(hashed, *_smallest(hashed, F.lit(True), n, bucket_bits, final_rows))


# ---------------------------------------------------------------------------
# M4: rebalance
# ---------------------------------------------------------------------------


def rebalance(
    df: DataFrame,
    ratio: float,
    seed: int = 42,
    key: str = ID_COLUMN,
    label_col: str = LABEL_COLUMN,
    final_rows: int = FINAL_ROWS,
) -> DataFrame:
    """With ``ratio`` above 1: every row labelled 1 and, per such row, ``ratio``
    rows labelled 0 (rounded down in total), the first in hash order; rows of
    other labels go. Otherwise the rows as they are.

    One grouped pass counts the ones and the zeros by hash digit. One filter
    over the input then keeps the ones and the zeros below the cut, so the
    input is read once more; only the share of the bucket at the cut is added."""
    if ratio <= 1.0:
        return df
    hashed = _with_hashes(df, seed, key)
    is_one, is_zero = (F.col(label_col) == y for y in (1, 0))
    _, shift = _levels(BUCKET_BITS)[0]
    groups = hashed.groupBy(F.when(is_zero, F.shiftright(F.col(_H), shift)).alias("digit"))
    counts = groups.agg(F.count_if(is_one).alias("ones"), F.count_if(is_zero).alias("zeros")).collect()
    wanted = int(ratio * sum(c["ones"] for c in counts))
    zeros = [(c["digit"], c["zeros"]) for c in counts if c["zeros"]]
    take, share = _smallest(hashed, is_zero, wanted, BUCKET_BITS, final_rows, zeros)
    return _gather(hashed, is_one | take, share)
