"""Box-plot statistics per category.

Values are compared exactly, or, if ``decimals`` is given, rounded to so many decimals: then sums that differ
in their last bits only fall on the same side of a fence and share a place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residua.operators.quantiles import group_quantiles

WHISKER = 1.5  # fixed value: whiskers reach at most this many interquartile ranges


def _fences(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    q = group_quantiles(df, by, value, (0.25, 0.5, 0.75)).select(
        *by, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )
    reach = (F.col("q3") - F.col("q1")) * WHISKER
    return q.select("*", (F.col("q1") - reach).alias("fence_low"), (F.col("q3") + reach).alias("fence_high"))


def _told(value: str, decimals: int | None) -> Column:
    return F.col(value) if decimals is None else F.round(value, decimals)


def _inside(value: str, decimals: int | None) -> Column:
    """Within the fences."""
    return _told(value, decimals).between(_told("fence_low", decimals), _told("fence_high", decimals))


def box_stats(df: DataFrame, by: Sequence[str], value: str, decimals: int | None = None) -> DataFrame:
    """Quartiles, whisker ends (the outermost values inside the fences) and counts per category.

    The quartiles are exact, for categories of any size.
    """
    inside = _inside(value, decimals)
    return (
        df.join(_fences(df, by, value), list(by))
        .groupBy(*by, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col(value))).alias("whisker_low"),
            F.max(F.when(inside, F.col(value))).alias("whisker_high"),
            F.count("*").alias("n"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def box_outliers(df: DataFrame, by: Sequence[str], value: str, decimals: int | None = None) -> DataFrame:
    """The rows outside the fences of their category."""
    inside = _inside(value, decimals)
    return df.join(_fences(df, by, value), list(by)).filter(~inside).select(*df.columns)


def place_by(
    df: DataFrame, order: str, within: Sequence[str] = (), decimals: int | None = None
) -> DataFrame:
    """``place`` of each category in ascending ``order``."""
    by_value = Window.partitionBy(*within).orderBy(_told(order, decimals))
    return df.withColumn("place", F.rank().over(by_value))
