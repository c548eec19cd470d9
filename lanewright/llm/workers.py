"""Memory of Python workers, which Spark keeps for later stages."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa


def give_back() -> None:
    """Return freed memory to the system, so that an idle worker doesn't hold what an earlier stage needed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not every C library has it
        pass


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A mapInArrow function that gives memory back when its task ends."""

    @wraps(run)
    def inner(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return inner


def in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 8 << 20, most: int = 2000) -> Iterator[pa.RecordBatch]:
    """Record batches of rows, cut when their texts and bytes reach ``size``: neither long texts nor many rows gather."""
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += sum(len(x) for x in r if isinstance(x, str | bytes))
        if n >= size or len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
