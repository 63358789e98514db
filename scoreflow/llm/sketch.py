"""Counts of 64-bit tokens in a fixed number of slots.

A slot counts all tokens that hash to it, so a token's count is never below
its true number. Tasks count in an array of their own, the arrays are added up
piece by piece on Spark, and the sum, of one size however many tokens there
are, comes to the driver. Counts only choose an order or a cheaper plan:
results never depend on how well they are told apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scoreflow.llm.common import freed_shuffles
from scoreflow.llm.hashing import U, mix

SLOTS, PIECE = 1 << 17, 1 << 11
PIECES = "piece int, counts array<bigint>"
# Tasks that add up pieces: there are never more than SLOTS / PIECE of them.
ADDERS = 16


class Counts:
    """What one task counts."""

    def __init__(self):
        self.slots = np.zeros(SLOTS, dtype=np.int64)

    def add(self, tokens: np.ndarray) -> None:
        self.slots += np.bincount(slot(tokens), minlength=SLOTS)

    def pieces(self) -> tuple[list[int], list[np.ndarray]]:
        parts = self.slots.reshape(-1, PIECE)
        used = np.flatnonzero(parts.any(1)).tolist()
        return used, [parts[i] for i in used]


def slot(tokens: np.ndarray) -> np.ndarray:
    return (mix(tokens ^ U(0x5EED)) >> U(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        flat = batch.column("counts").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, PIECE)
        for i, piece in enumerate(batch.column("piece").to_pylist()):
            sums[piece] = sums[piece] + flat[i] if piece in sums else flat[i].copy()
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64()))], names=["piece", "counts"]
    )


def total(pieces: DataFrame) -> np.ndarray:
    """The summed slots of all tasks' (piece, counts)."""
    with freed_shuffles(pieces.sparkSession):
        found = pieces.repartition("piece").coalesce(ADDERS).mapInArrow(_added, PIECES).toArrow()
    out = np.zeros(SLOTS, dtype=np.int64)
    for piece, counts in zip(found["piece"].to_pylist(), found["counts"], strict=True):
        out[piece * PIECE : (piece + 1) * PIECE] += counts.values.to_numpy()
    return out
