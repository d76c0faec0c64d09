"""Arrow batches in slices of bounded size, so that what a Python worker holds does not grow with the session's batch size."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa

#: Bytes of a slice; a longer row is a slice of its own.
SLICE_BYTES = 4 << 20

_trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def release() -> None:
    """Give memory that is free but held by the allocators back to the system, as workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    _trim(0)


def lean(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """All rows of the batches, in order, in slices of about `limit` bytes at most; batches without rows are passed over."""
    for b in batches:
        usual = max(1, b.num_rows * limit // max(1, b.nbytes))
        start = 0
        while start < b.num_rows:
            rows = usual
            while rows > 1 and b.slice(start, rows).nbytes > 2 * limit:  # long rows among short ones
                rows //= 2
            yield b.slice(start, rows)
            release()
            start += rows
