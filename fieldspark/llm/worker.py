"""Python workers outlive their tasks and serve the stages that follow: what a task no longer needs goes back at its end."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa


def release() -> None:
    """Hands freed Arrow buffers and freed heap pages back to the system (the latter with glibc only)."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The function of a task over batches, followed by release()."""

    @wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole
