"""Fixed-width histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: str, bins: int = 30, centred: bool = False) -> DataFrame:
    """``(bin, low, high, n)`` for bins 1 to ``bins``, empty ones included.

    The bins cut the range from the least to the greatest value, which belongs to the last bin.
    ``centred`` puts the centre of the first bin on the least value and that of the last bin on
    the greatest, as plotting libraries do.
    """
    values = df.select(F.col(value).alias("value")).filter(F.col(value).isNotNull())
    edges = values.agg(F.min("value").alias("least"), F.max("value").alias("greatest"))
    spread = F.col("greatest") - F.col("least")
    if centred:
        width = spread / max(bins - 1, 1)
        start = F.col("least") - width / 2
    else:
        width = spread / bins
        start = F.col("least")
    frame = edges.select(F.struct(start.alias("start"), width.alias("width")).alias("frame"))
    framed = values.withColumn("frame", frame.scalar())
    place = F.floor((F.col("value") - F.col("frame.start")) / F.nullif(F.col("frame.width"), F.lit(0.0)))
    inside = F.greatest(F.lit(1), F.least(F.lit(bins), F.coalesce(place, F.lit(0)) + 1))
    counts = framed.groupBy(inside.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    every = frame.select(
        "frame.*", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")
    ).filter("start IS NOT NULL")
    return every.join(counts, "bin", "left").select(
        "bin",
        (F.col("start") + (F.col("bin") - 1) * F.col("width")).alias("low"),
        (F.col("start") + F.col("bin") * F.col("width")).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
