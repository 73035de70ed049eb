"""What a Python worker keeps between tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import pyarrow as pa

from vacantia.llm import rolling


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    """The C library's call that returns free memory to the system; None where it has none."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):
        return None


def give_back() -> None:
    """Return what the allocators hold but nothing uses; tables of powers are computed again when wanted."""
    rolling._powers.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim:
        trim(0)


def tidy(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` on the batches of a task, after which its worker gives unused memory back.

    Workers wait for later tasks, of other steps too, and would count all that time with the most that a task of theirs took.
    """
    @wraps(work)
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(parts)
        finally:
            give_back()
    return run
