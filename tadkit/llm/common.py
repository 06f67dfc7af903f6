"""Shared pieces of the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc

import pyarrow as pa
from pyspark.sql import SparkSession

from tadkit.session import drop_table, scratch_path, ship_package, table, written  # noqa: F401

# Rows per Arrow batch handed to a Python worker.  Documents are long, so a
# batch is kept small to bound a worker's memory.
BATCH_ROWS = 512


def give_back() -> None:
    """Hands a worker's free memory back to the machine, as it waits for its next task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):          # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def prepare(spark: SparkSession) -> None:
    """Make the package importable on executors and bound Arrow batches."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
