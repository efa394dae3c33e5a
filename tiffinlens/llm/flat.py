"""Many short lists laid end to end in one array."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Where each list begins, and after the last where all end."""
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges that begin at ``starts``, one range after the other."""
    before = starts_of(lengths)
    return np.repeat(starts.astype(np.int64) - before[:-1], lengths) + np.arange(before[-1])


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.LargeBinaryArray:
    """Lists of uint32 as the bytes of each, which Arrow picks and joins faster than by positions."""
    data, ends = pa.py_buffer(np.ascontiguousarray(values, np.uint32)), pa.py_buffer(bounds.astype(np.int64) * 4)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, ends, data])


def values_of(found: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(all values end to end, where each list begins and the last ends) of lists that ``take`` picked from ``lists``."""
    if not len(found):
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    _, ends, data = found.buffers()
    bounds = np.frombuffer(ends, np.int64, len(found) + 1, found.offset * 8) // 4
    values = np.frombuffer(data, np.uint32, int(bounds[-1])) if bounds[-1] else np.zeros(0, np.uint32)
    return values[bounds[0] :], bounds - bounds[0]
