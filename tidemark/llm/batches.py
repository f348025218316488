"""Arrow batches of a bounded number of bytes, and workers that give memory back."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 32 << 20


def bound_batches(spark: SparkSession) -> None:
    """End a batch at some megabytes, not only at a number of rows.

    Spark's own limit counts rows, and ten thousand long texts can be gigabytes.
    A session that sets the limit itself keeps its value.
    """
    if spark.conf.get(LIMIT, None) is None:
        spark.conf.set(LIMIT, str(BATCH_BYTES))


def give_back() -> None:
    """Return freed memory to the system: workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # the GNU C library's
        trim(0)


def tidy(run: Callable) -> Callable:
    """A function over batches that gives memory back when the task ends."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped
