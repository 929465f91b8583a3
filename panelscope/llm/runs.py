"""Runs of equal keys in a sorted stream of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def changes(column: pa.Array) -> np.ndarray:
    """Whether each row but the first differs from the one before; nulls are equal to each other."""
    a, b = column.slice(0, len(column) - 1), column.slice(1)
    differ = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
    return differ.to_numpy(zero_copy_only=False)


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[int]) -> Iterator[pa.Table]:
    """One table for each run of rows that are equal in the columns `keys`; one run is held at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        differ = np.zeros(batch.num_rows, bool)
        for k in keys:
            column = batch.column(k)
            differ[1:] |= changes(column)
            if held:
                differ[0] |= held[-1].column(k)[-1] != column[0]
        at = 0
        for cut in np.flatnonzero(differ):
            if cut > at:
                held.append(batch.slice(at, cut - at))
            yield pa.Table.from_batches(held)
            held, at = [], int(cut)
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def fixed_rows(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """A binary column without nulls, of values that are all `width` bytes long, as a matrix of bytes."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts = []
    for c in chunks:
        c = c.cast(pa.large_binary())
        ends = np.frombuffer(c.buffers()[1], np.int64)[c.offset : c.offset + len(c) + 1]
        data = np.frombuffer(c.buffers()[2], np.uint8)[ends[0] : ends[-1]] if len(c) else np.zeros(0, np.uint8)
        parts.append(data.reshape(-1, width))
    return np.concatenate(parts) if parts else np.zeros((0, width), np.uint8)
