"""Python workers outlive their tasks and wait for others. What a task has freed goes back to the system at its end; otherwise the C library
keeps it, beside a JVM that needs the room in later stages."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def returned(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for ``mapInArrow`` that gives memory back when its rows have ended."""
    def outer(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return outer


def returned_by_group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same for a function of a group's table."""
    def outer(table):
        try:
            return run(table)
        finally:
            give_back()
    return outer
