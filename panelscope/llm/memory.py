"""Memory of Python workers, which outlive their tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps
from typing import TypeVar

import pyarrow as pa

T = TypeVar("T")


def give_back() -> None:
    """What Arrow and the C library hold of freed memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def giving_back(run: Callable[[Iterator[T]], Iterator[T]]) -> Callable[[Iterator[T]], Iterator[T]]:
    """A map function that leaves a small worker behind: workers wait for the next task of any stage beside those at work."""

    @wraps(run)
    def wrapped(batches: Iterator[T]) -> Iterator[T]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped
