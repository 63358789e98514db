"""Vectorised 64-bit hashing of words and word windows inside Arrow batches.

A batch's texts are one byte buffer. Word bounds come from a mask of the
separators, word hashes from differences of one running polynomial sum, and
window hashes from a second one over the words; every step is a pass over an
array, whatever the lengths of the texts. Sums wrap modulo 2^64 and are mixed
before use.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

U = np.uint64
# Odd multipliers (so powers can be inverted modulo 2^64) and mixing constants.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95
MASK = (1 << 64) - 1

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i for i < n at least, modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            t = np.ones(size, dtype=U)
            done = 1
            while done < size:
                step = min(done, size - done)
                t[done : done + step] = t[:step] * U(pow(b, done, 1 << 64))
                done += step
            tables.append(t)
        have = _powers[base] = (tables[0], tables[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@dataclass(frozen=True)
class BatchWords:
    """Words of all texts of a batch in order. `first[i]` is the number of
    words before text i; `begin` and `end` are byte offsets into `data`."""

    data: np.ndarray
    first: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    hashes: np.ndarray

    @property
    def document(self) -> np.ndarray:
        counts = np.diff(self.first)
        return np.repeat(np.arange(len(counts), dtype=np.int64), counts)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of the texts); a null text is empty."""
    column = pa.array(column.fill_null("")) if column.null_count else column
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(at) or at[-1] == at[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def batch_words(column: pa.Array, lower: bool = False) -> BatchWords:
    """Words between ASCII white space (x20, x09-x0D) of each text."""
    data, at = text_bytes(column)
    if lower and len(data):
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    cut = at[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    starts[cut] = inside[cut]
    begin = np.flatnonzero(starts)
    # A word ends before the next separator or text.
    stops = ~inside
    stops[cut] |= True
    ends = np.append(np.flatnonzero(stops), len(data))
    end = ends[np.searchsorted(ends, begin, side="right")] if len(begin) else begin
    first = np.searchsorted(begin, at)
    return BatchWords(data, first, begin, end, _range_hashes(data, begin, end))


def _range_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = _power_table(BYTE_BASE, len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=U)
    np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(U))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` words from each place on; places whose window runs
    past the last word are left out (windows may cross texts: see `inside`)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    up, down = _power_table(WORD_BASE, len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=U)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix((sums[size:] - sums[:-size])[:n] * down[:n])


def inside(first: np.ndarray, size: int, n: int) -> np.ndarray:
    """Whether the window of `size` words at each of `n` places stays in one text."""
    ok = np.ones(n, dtype=bool)
    for k in range(1, size):
        at = first[1:-1] - k
        ok[at[(at >= 0) & (at < n)]] = False
    return ok


# Text bytes worked on at once; a longer single text is a slice of its own.
SLICE_BYTES = 1 << 19


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES):
    """Consecutive row ranges of a batch holding about `limit` bytes of text."""
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0))
    begin, size = 0, 0
    for i, n in enumerate(lengths):
        if i > begin and size + n > limit:
            yield batch.slice(begin, i - begin)
            begin, size = i, 0
        size += int(n)
    if begin < len(lengths):
        yield batch.slice(begin)
