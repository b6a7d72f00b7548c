"""Small helpers for functions that run on Arrow batches inside tasks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute

#: Characters of text that one step of a batched numpy computation holds at once.
STEP_CHARS = 1 << 21


def steps(batch: pa.RecordBatch, text: str | int = "text", most: int = STEP_CHARS) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` of about ``most`` bytes of ``text``, one row at least.

    Temporary arrays are bounded by the step or by the longest single text,
    never by the size of the batch Spark delivers.
    """
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_pylist()
    first = total = 0
    for row, length in enumerate(lengths):
        if total and total + length > most:
            yield batch.slice(first, row - first)
            first, total = row, 0
        total += length
    if first < len(lengths):
        yield batch.slice(first)


def to_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def give_back() -> None:
    """Return memory that Python and Arrow have freed, but keep for later use, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone keeps the heap of large arrays
    if trim is not None:
        trim(0)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, giving back what it has freed after each batch and at its end.

    Spark keeps a task's worker for tasks of later stages, and what the worker
    still holds counts against the executor while these run in the JVM. At the
    end Python's lists of free objects go too: a few of them hold whole arenas.
    """

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                del batch
                give_back()

        try:
            yield from run(handed())
        finally:
            gc.collect()
            give_back()

    return tidy
