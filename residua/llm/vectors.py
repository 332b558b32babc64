"""Vectors out of a table: which of them count, and cosines in double precision."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, vec, dim) of the vectors that count: not null, not all zero, every component a finite number.

    Rows with the same id are one vector (the least of them, component by component); a null id is none.
    """
    rows = table.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    finite = F.forall("vec", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    rows = rows.where(F.col("id").isNotNull() & finite & F.exists("vec", lambda x: x != 0))
    return rows.groupBy("id").agg(F.min("vec").alias("vec")).withColumn("dim", F.size("vec"))


def matrix(column) -> np.ndarray:
    """The vectors as float64 rows."""
    return np.array([np.asarray(v, np.float64) for v in column])


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; safe for components near the ends of the range."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / lengths(x)[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``, one summing order for every pair."""
    with np.errstate(over="ignore", under="ignore"):
        size = lengths(a) * lengths(b)
        value = (a * b).sum(axis=1) / size
    odd = ~np.isfinite(value) | (size < 1e-290)
    if odd.any():
        value[odd] = (unit(a[odd]) * unit(b[odd])).sum(axis=1)
    return np.clip(value, -1.0, 1.0)
