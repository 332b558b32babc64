"""Joins the rest of the package uses.

None of them carries a broadcast hint.  Spark broadcasts a side whose measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and sorts and merges otherwise; with adaptive execution it
splits a partition that one hot key has filled.  The left side of a left or semi join can always
be split, and every join here has the rating rows on the left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.session import beyond_session, dealt, parts_for


def _natural(left: DataFrame, right: DataFrame) -> tuple[list[str], DataFrame, F.Column]:
    """Shared columns, the right side with those renamed, and the NULL-equals-NULL condition."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the two sides share no column")
    renamed = right.select(
        *[F.col(c).alias(f"__right_{c}" if c in shared else c) for c in right.columns]
    )
    same = [F.col(c).eqNullSafe(F.col(f"__right_{c}")) for c in shared]
    return shared, renamed, reduce(lambda a, b: a & b, same)


def natural_left_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on all shared columns; NULL matches NULL."""
    shared, renamed, condition = _natural(left, right)
    return left.join(renamed, condition, "left").drop(*[f"__right_{c}" for c in shared])


def natural_anti_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` without an equal row in ``right`` on all shared columns; NULL matches NULL."""
    _, renamed, condition = _natural(left, right)
    return left.join(renamed, condition, "left_anti")


def dealt_for(rows: DataFrame, count: int, side: DataFrame, key: str) -> DataFrame:
    """``side``, to be left-joined by ``key`` to ``rows``, ``count`` of them, in as many parts as they need; they follow it.

    If a part would get over twice its share of the rows, as with a hot or an often missing key, all is left to adaptive
    execution, which can split it.
    """
    parts = parts_for(count)
    if not beyond_session(side, parts):
        return side
    part = F.pmod(F.hash(key), F.lit(parts)).alias("part")  # where a shuffle by the key puts a row
    fullest = rows.groupBy(part).agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"]
    return dealt(side, parts, key) if parts_for(fullest) <= 2 else side


def with_known_keys(rows: DataFrame, known: DataFrame, *keys: str) -> DataFrame:
    """Rows whose every key, taken on its own, occurs in ``known``."""
    for key in keys:
        rows = rows.join(known.select(key).distinct(), key, "left_semi")
    return rows
