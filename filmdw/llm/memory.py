"""Memory of tasks that work on whole texts."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import SparkSession

_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: rows that a task is given at a time; the default of 10,000 texts is held by JVM and Python, both ways
BATCH = {_ROWS: "1000"}


def bounded_batches(spark: SparkSession) -> None:
    """For the rest of the session, texts go to tasks in batches of ``BATCH``, unless the session says
    otherwise. For what is run after it was defined, where ``session.conf`` does not reach."""
    if spark.conf.get(_ROWS, None) is None:
        spark.conf.set(_ROWS, BATCH[_ROWS])


def give_back() -> None:
    """Return freed memory to the system: a worker lives on, idle, through tasks that need no Python."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)
