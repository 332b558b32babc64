"""Error measures as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PROPAGATE = "propagate"  # one missing value makes the result missing
SKIP = "skip"  # rows with a missing value are left out


def mean(value: Column, policy: str = PROPAGATE) -> Column:
    if policy == SKIP:
        return F.avg(value)
    if policy != PROPAGATE:
        raise ValueError(f"unknown policy {policy!r}")
    return F.when(F.count(value) == F.count("*"), F.avg(value))


def rmse(truth: Column, prediction: Column, policy: str = PROPAGATE) -> Column:
    """Root mean squared error."""
    error = truth - prediction
    return F.sqrt(mean(error * error, policy))
