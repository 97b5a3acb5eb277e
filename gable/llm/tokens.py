"""Words of whole Arrow batches as 64-bit hashes, without a Python object per word."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; a block ends between words.
BLOCK = 1 << 21

_LIBC = ctypes.CDLL(None)
_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SAME = np.arange(256, dtype=np.uint8)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (one-to-one)."""
    x = x.astype(_U, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> _U(30)
        x *= _U(0xBF58476D1CE4E5B9)
        x ^= x >> _U(27)
        x *= _U(0x94D049BB133111EB)
        x ^= x >> _U(31)
    return x


with np.errstate(over="ignore"):
    _BYTES = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            have = np.cumprod(np.concatenate(([_U(1)], np.full(max(n, BLOCK + 1), base, dtype=_U))))
        if n <= 4 * BLOCK:
            _POWERS[base] = have
    return have[:n]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values of a string column end to end, and where each value starts (one more at the end)."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of each text in order, and the number of words of each text.

    Words are runs without white space (0x20, 0x09 to 0x0D); ``lower`` folds A to Z.
    """
    data, offsets = flat(column)
    inside = ~_BLANK[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    counts = np.diff(np.searchsorted(start, offsets))
    table = _BYTES[_LOWER if lower else _SAME]
    out = np.empty(len(start), dtype=_U)
    at = 0
    inverse = pow(_BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        while at < len(start):
            to = max(at + 1, int(np.searchsorted(end, start[at] + BLOCK, "right")))
            lo, hi = int(start[at]), int(end[to - 1])
            sums = np.zeros(hi - lo + 1, dtype=_U)
            np.cumsum(table[data[lo:hi]] * _powers(_BASE, hi - lo), out=sums[1:])
            s = start[at:to] - lo
            out[at:to] = (sums[end[at:to] - lo] - sums[s]) * _powers(inverse, hi - lo)[s] + (end[at:to] - start[at:to]).astype(_U)
            at = to
    return mix(out), counts


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``size`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.diff(flat(batch.column(column))[1])
        group = np.cumsum(lengths) // size
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if hi > lo:
                yield batch.slice(lo, hi - lo)
    give_back()


def give_back() -> None:
    """Returns freed memory to the system: a worker process may idle through later stages that need it."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)
