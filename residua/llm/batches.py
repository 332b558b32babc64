"""Smaller Arrow batches for rows that hold whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside hand at most so many rows at once to Python; the session's own setting comes back after."""
    before = spark.conf.get(KEY)
    spark.conf.set(KEY, str(rows))
    try:
        yield
    finally:
        spark.conf.set(KEY, before)
