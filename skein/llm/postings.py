"""Lists of small integers as variable-length bytes."""

from __future__ import annotations

import numpy as np


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, sizes): seven bits a byte, the lowest first, the high bit where more follow."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        more = values >= np.uint64(1 << bits)
        if not more.any():
            break
        sizes += more
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(sizes.max()) if len(sizes) else 0):
        has = sizes > k
        part = (values[has] >> np.uint64(7 * k)) & np.uint64(127)
        out[ends[has] - sizes[has] + k] = part.astype(np.uint8) | np.where(sizes[has] > k + 1, 128, 0).astype(np.uint8)
    return out, sizes


def unpack(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, starts): the integers of pack's bytes, and where each begins."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    last = np.flatnonzero(data < 128)
    starts = np.concatenate([[0], last[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(starts, last - starts + 1)
    parts = (data & 127).astype(np.int64) << (7 * place)
    return np.add.reduceat(parts, starts), starts
