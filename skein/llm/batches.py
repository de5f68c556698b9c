"""Arrow batches cut into pieces of bounded bytes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes that are worked on at once; one longer text is a piece of its own.
PIECE_BYTES = 2 << 20


def text_pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, data, offsets): consecutive rows and their texts' UTF-8 bytes, null as empty.

    ``data[offsets[i]:offsets[i + 1]]`` is the text of row i of ``rows``. At
    the end memory goes back to the system: workers are used again by tasks of
    other stages.
    """
    try:
        yield from _pieces(batches, column, limit)
    finally:
        release()


def release() -> None:
    """Return freed memory of this process to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        return  # another C library


def _pieces(batches, column, limit):
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        if pa.types.is_string(texts.type):
            texts = texts.cast(pa.large_string())
        if texts.null_count:
            texts = texts.fill_null("")
        n = len(texts)
        if not n:
            continue
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8)
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        first = 0
        while first < n:
            last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
            last = min(last, n)
            yield batch.slice(first, last - first), raw[at[first] : at[last]], at[first : last + 1] - at[first]
            first = last
