"""Stable per-row hashes for deterministic sampling and splitting.

``rand()`` and ``randomSplit`` depend on how rows happen to be partitioned
and ordered, so the same seed gives different rows on a different cluster
size. A hash of (seed, key) gives every row the same draw wherever it lives.
Both hashes are plain ``md5`` prefixes, which DuckDB computes identically.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Width of the order hash: 15 hex digits = 60 bits, always a positive bigint.
ORDER_HASH_BITS = 60
_UNIT_DIGITS = 8  # 32 bits for the [0, 1) draw


def _salted(seed: int | str, keys: tuple[ColumnOrName, ...]) -> Column:
    parts = [F.lit(str(seed))] + [F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]
    return F.md5(F.concat_ws("|", *parts))


def unit_hash(seed: int | str, *keys: ColumnOrName) -> Column:
    """A uniform draw in [0, 1) from md5(seed|key...): first 32 bits / 2^32."""
    digits = F.substring(_salted(seed, keys), 1, _UNIT_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(1 << 32))


def order_hash(seed: int | str, *keys: ColumnOrName) -> Column:
    """A 60-bit non-negative integer from md5(seed|key...), used as a random
    but reproducible sort key."""
    digits = F.substring(_salted(seed, keys), 1, ORDER_HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("bigint")
