"""Texts of an Arrow batch as arrays of bytes, and back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from airshed.llm.common import SPACE_CHARS

SLICE_BYTES = 1 << 23

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACE_CHARS.encode())] = True


def blocks(total: int, size: int) -> Iterator[tuple[int, int]]:
    for at in range(0, total, size):
        yield at, min(at + size, total)


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ends of a text column, without a copy."""
    column = column.cast(pa.large_string())
    if not len(column):
        return np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[at[0]:at[-1]] if held is not None else np.empty(0, np.uint8)
    at = at - at[0]
    return data, at[:-1], at[1:]


def text_column(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Texts laid end to end as a column, without a copy."""
    offsets = np.append(starts, starts[-1] + lengths[-1] if len(starts) else 0).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).cast(pa.string())


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of rows with about ``most`` bytes of text; a longer text is a piece of its own."""
    _, starts, ends = text_arrays(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + most, "right")))
        yield batch.slice(at, to - at)
        at = to
