"""Memory of Python workers, which outlive their tasks: an executor's limit counts what idle ones hold."""

from __future__ import annotations

import ctypes
import functools

import pyarrow as pa

#: What this process holds beyond a task for the next one of its kind, such as a tokenizer's table.
HELD: dict = {}


def give_back() -> None:
    """Gives memory that nothing uses any more back to the system, where its allocators allow that."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not glibc
        pass


def lean(work):
    """`work`, a function for mapInArrow, with nothing held for tasks of other kinds while it runs, and
    with its own memory given back when it ends."""

    @functools.wraps(work)
    def run(batches):
        HELD.clear()
        give_back()
        try:
            yield from work(batches)
        finally:
            give_back()

    return run
