"""Vectorised word scanning over Arrow string columns.

Words are maximal runs of bytes other than space, \\t, \\n, \\v, \\f and \\r; a
whole slice of documents is scanned in one numpy pass instead of word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes handled at once; bounds a task's memory whatever the Arrow batch holds. A longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = 0x9E3779B97F4A7C15  # odd: has an inverse modulo 2**64


def _powers(base: int) -> np.ndarray:
    out = np.full(SLICE_BYTES + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS, _INVERSES = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(column: pa.Array | pa.ChunkedArray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, past last row, bytes, row offsets) of runs of rows with up to `most` bytes; nulls are empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, ends (exclusive) and row numbers; words don't cross rows."""
    inside = ~_SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each word's bytes and length, mixed; equal words hash alike in every slice and task."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        base = int(starts[lo])
        hi = max(lo + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
        if ends[lo] - base > SLICE_BYTES:  # one word longer than a slice
            total = 0
            for k in range(base, int(ends[lo]), SLICE_BYTES):
                part = raw[k : min(k + SLICE_BYTES, int(ends[lo]))].astype(np.uint64) + np.uint64(1)
                total += int((part * _POWERS[: len(part)]).sum(dtype=np.uint64)) * pow(_BASE, k - base, 1 << 64)
            out[lo] = total % (1 << 64)
            lo += 1
            continue
        part = raw[base : int(ends[hi - 1])].astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * _POWERS[: len(part)], out=sums[1:])
        s = starts[lo:hi] - base
        out[lo:hi] = (sums[ends[lo:hi] - base] - sums[s]) * _INVERSES[s]
        lo = hi
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(words: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all `width`-word windows within a row, and the index of each window's first word."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(rows[: n] == rows[width - 1 :])
    total = np.zeros(len(at), np.uint64)
    for k in range(width):
        total = total * np.uint64(0xA0761D6478BD642F) + words[at + k]
    return mix(total), at


def code_points(raw: np.ndarray, offsets: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
    """Code points per row, or of the bytes that the mask `of` marks."""
    lead = (raw & 0xC0) != 0x80
    if of is not None:
        lead &= of
    sums = np.concatenate([[0], np.cumsum(lead, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def not_space(raw: np.ndarray) -> np.ndarray:
    return ~_SPACE[raw]


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all other bytes as they are."""
    return np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
