"""Exact quantiles of a column, of all rows or per group, from the counts of its values."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from residua.operators.ranks import running_count
from residua.session import stored


def in_value_parts(counts: DataFrame, value: str) -> DataFrame:
    """``counts`` sorted by value over all tasks, with ``part``, and written once, so that the parts stay the same."""
    return stored(counts.repartitionByRange(value).withColumn("part", F.spark_partition_id()), "value-parts")


def quantiles(counts: DataFrame, value: str, probs: Sequence[float]) -> tuple[list[float], int]:
    """The quantiles, interpolated between neighbours, and the row count; ``counts`` has ``value`` and ``n``."""
    return quantiles_of_parts(in_value_parts(counts.select(value, "n"), value), value, probs)


def quantiles_of_parts(parts: DataFrame, value: str, probs: Sequence[float]) -> tuple[list[float], int]:
    """The same from rows with ``value``, ``n`` and ``part``, where the parts follow one another in value.

    What the driver adds up is one row count per part; only the parts that hold a wanted rank are looked at closer.
    """
    sizes = sorted((r["part"], r["n"]) for r in parts.groupBy("part").agg(F.sum("n").alias("n")).collect())
    rows = sum(n for _, n in sizes)
    if not rows:
        return [], 0
    positions = [(rows - 1) * p for p in probs]
    ranks = sorted({r for at in positions for r in (math.floor(at), math.ceil(at))})
    at_rank = _at_ranks(parts, value, sizes, ranks)

    def between(at: float) -> float:
        low, high = math.floor(at), math.ceil(at)
        if low == high:
            return at_rank[low]
        return (high - at) * at_rank[low] + (at - low) * at_rank[high]

    return [between(at) for at in positions], rows


def _at_ranks(parts: DataFrame, value: str, sizes: list[tuple[int, int]], ranks: list[int]) -> dict[int, float]:
    """The value at each of a handful of 0-based ranks."""
    wanted, below = [], 0
    for part, n in sizes:
        inside = [r - below for r in ranks if below <= r < below + n]
        wanted += [(part, r, r + below) for r in inside]
        below += n
    near = F.col("part").isin(sorted({part for part, _, _ in wanted}))
    asked = F.array(*[F.struct(*[F.lit(x).cast("bigint").alias(name) for name, x in zip(("part", "at", "rank"), w)]) for w in wanted])
    values = parts.filter(near).groupBy("part", value).agg(F.sum("n").alias("n"))
    counted = running_count(values, value, ["part"])

    def holds(w):
        return (w["part"] == F.col("part")) & (w["at"] >= F.col("below")) & (w["at"] < F.col("below") + F.col("n"))

    found = counted.select(value, F.explode(F.filter(asked, holds)).alias("w"))
    return {row["rank"]: row[value] for row in found.select(value, "w.rank").collect()}


def group_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """(by, q): the quantiles of each group as an array, interpolated between neighbours; NULL for a group without values.

    The counts of values are sorted by group and value over all tasks, so a group of any size is spread over many parts; only
    the parts that hold a wanted rank are counted through, each by itself.
    """
    counts = df.groupBy(*by, value).agg(F.count(value).alias("n"))
    sorted_counts = counts.repartitionByRange(*by, value).withColumn("part", F.spark_partition_id())
    parts = stored(sorted_counts, "group-value-parts")
    # one row per group and part
    sizes = parts.groupBy(*by, "part").agg(F.sum("n").alias("size"))
    in_order = Window.partitionBy(*by).orderBy("part")
    sizes = sizes.withColumn("below", F.sum("size").over(in_order) - F.col("size"))
    sizes = sizes.withColumn("rows", F.sum("size").over(Window.partitionBy(*by)))
    asked = [F.struct(F.lit(i).alias("place"), ((F.col("rows") - 1) * p).alias("position")) for i, p in enumerate(probs)]
    ranks = sizes.select(*by, "part", "size", "below", F.explode(F.array(*asked)).alias("w")).select("*", "w.*")
    ranks = ranks.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("position"), F.ceil("position")))))
    ranks = ranks.filter("rank >= below AND rank < below + size")
    # each rank's share in its quantile
    gap = F.abs(F.col("position") - F.col("rank"))
    ranks = ranks.select(*by, "part", "place", (F.col("rank") - F.col("below")).alias("at"), "rank", (1 - gap).alias("share"))
    near = parts.filter("n > 0").join(ranks.select(*by, "part").distinct(), [*by, "part"], "left_semi")
    upto = Window.partitionBy(*by, "part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    counted = near.withColumn("upto", F.sum("n").over(upto))
    met = counted.join(ranks, [*by, "part"]).filter("at < upto AND at >= upto - n")
    weighted = met.withColumn("__x", F.col(value) * F.col("share"))
    each = weighted.groupBy(*by, "place").agg(F.sum("__x").alias("__x"))
    found = each.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "__x"))), lambda w: w["__x"]).alias("q"))
    return sizes.select(*by).distinct().join(found, list(by), "left")
