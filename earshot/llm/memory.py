"""Memory of Python workers.

A worker serves one stage after the other, and its executor has one for each
core.  What arrays took and gave free stays with the allocators of C and Arrow,
so without more a worker holds the most that any of its tasks ever had.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

# Of the GNU C library; others give back by themselves or not at all.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Return this process's free memory to the system."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def giving_back(run: Run) -> Run:
    """``run``, for mapInArrow, returning free memory after each batch given to
    it and after the last."""

    def frugal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                give_back()

        yield from run(each())
        give_back()

    return frugal
