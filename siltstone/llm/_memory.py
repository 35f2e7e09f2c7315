"""Python workers live on between tasks; what they have freed should go back to the machine."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import SparkSession

try:
    _LIBC = ctypes.CDLL("libc.so.6")
except OSError:  # another C library: it keeps what it keeps
    _LIBC = None


def trim() -> None:
    """Return freed memory of this process to the system; a few milliseconds."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within, plans that run send Python at most so many rows at once: for tables of few and large rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
