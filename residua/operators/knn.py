"""Nearest-neighbour smoothing of a group curve, and the choice of k by bootstrap.

The exact neighbours are found in one lazy plan, without comparing all groups with all.  Groups at the same place
are one point.  Each point is put into one cell of every grid of a fixed ladder, whose widths are powers of two.
The narrowest cell around a place that holds k neighbours bounds how far to look: no further than its farthest
corner.  The place then meets the points of the few cells of that grid within the bound, which are ranked by their true
distance; all ties of the k-th are kept.

A cell four times as small holds less than k, so on the whole a point is met by a number of places that grows with k, not with
the table.  Where no cell holds k neighbours (fewer than k on its side of zero) a place looks at all points.  Points
that differ by less than the narrowest width share cells at every grid, which costs time and nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residua.operators.ranks import hash_number, numbered

FEATURES = ("year", "n")
K_GRID = tuple(range(1, 52, 2))  # fixed values: 1, 3, ..., 51
RESAMPLES = 25  # fixed value

LADDER = (*range(-10, 41), 48, 56, 64)  # widths as powers of two
UNBOUNDED = 1100  # 2 to this power is infinite, so its grid has one cell
ROUNDING = 1 + 1e-9
BITS = 51  # of the number of a cell; doubles tell 53


def _known(features: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in features])


def _in_cells(points: DataFrame, features: Sequence[str], levels: Sequence[int], bits: int) -> DataFrame:
    """A row per level with ``__level`` and a ``__bin_`` column per feature; none where a bin needs more than ``bits``."""
    out = points.withColumn("__level", F.explode(F.array(*[F.lit(x) for x in levels])))
    out = out.withColumn("__width", F.pow(F.lit(2.0), F.col("__level")))
    for f in features:
        x = F.col(f).cast("double") / F.col("__width")
        out = out.filter(F.abs(x) < 2.0**bits).withColumn(f"__bin_{f}", F.floor(x))
    return out.drop("__width")


def _bounds(
    points: DataFrame, weights: Sequence[str], k: int, features: Sequence[str], own: Sequence[str]
) -> DataFrame:
    """Places, with their ``own`` columns and the ``__level`` of the narrowest cell that holds ``k`` of every weight."""
    cell = ["__level", *[f"__bin_{f}" for f in features]]
    cells = _in_cells(points, features, LADDER, BITS)
    held = F.expr(" AND ".join(f"sum({w}) >= {k}" for w in weights))
    full = cells.groupBy(*cell).agg(held.alias("__full")).filter("__full").select(*cell)
    level = cells.select(*features, *cell).join(full, cell).groupBy(*features).agg(F.min("__level").alias("__level"))
    return (
        points.select(*features, *own)
        .join(level, list(features), "left")
        .withColumn("__level", F.coalesce("__level", F.lit(UNBOUNDED)))
    )


def _met(
    points: DataFrame, weights: Sequence[str], k: int, features: Sequence[str], own: Sequence[str] = ()
) -> DataFrame:
    """A row for each place and each point that can be among the ``k`` nearest, with the squared distance ``__d2``.

    The columns of ``features`` and ``own`` are the place's, the others the point's.
    """
    asked = _bounds(points, weights, k, features, own)
    width = F.pow(F.lit(2.0), F.col("__level"))
    corner = []
    for f in features:
        x = F.col(f).cast("double")
        low = F.floor(x / width) * width
        corner.append(F.greatest(x - low, low + width - x))
    reach = F.sqrt(reduce(lambda a, b: a + b, [c * c for c in corner])) * ROUNDING
    asked = asked.withColumn("__reach", F.when(F.col("__level") < UNBOUNDED, reach))
    for f in features:
        x = F.col(f).cast("double")
        low, high = F.floor((x - F.col("__reach")) / width), F.floor((x + F.col("__reach")) / width)
        bins = F.when(F.col("__reach").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(low, high))
        asked = asked.withColumn(f"__bin_{f}", F.explode(bins))
    # one bit more, for the cells beside those of a place
    cells = _in_cells(points.drop(*own), features, (*LADDER, UNBOUNDED), BITS + 1)
    for f in features:
        cells = cells.withColumnRenamed(f, f"__p_{f}")
    away = [F.col(f).cast("double") - F.col(f"__p_{f}").cast("double") for f in features]
    return (
        asked.join(cells, ["__level", *[f"__bin_{f}" for f in features]])
        .withColumn("__d2", reduce(lambda a, b: a + b, [a * a for a in away]))
        .filter(F.col("__reach").isNull() | (F.col("__d2") <= F.col("__reach") * F.col("__reach")))
        .drop("__level", "__reach", *[f"__bin_{f}" for f in features], *[f"__p_{f}" for f in features])
    )


def _nearer(weight: str, within: Sequence[str]) -> Column:
    """How much of the weight is strictly nearer; points at one distance have the same."""
    by_distance = Window.partitionBy(*within).orderBy("__d2")
    upto = F.sum(weight).over(by_distance.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    level = F.sum(weight).over(by_distance.rangeBetween(Window.currentRow, Window.currentRow))
    return upto - level


def knn_smooth(
    groups: DataFrame, k: int, features: Sequence[str] = FEATURES, target: str = "b"
) -> DataFrame:
    """``groups`` with ``knn``; a group counts as its own neighbour.

    A group with an unknown feature or target is no neighbour, and one with an unknown feature
    gets no ``knn``.
    """
    points = (
        groups.filter(_known(features))
        .groupBy(*features)
        .agg(F.count(target).alias("__w"), F.coalesce(F.sum(target), F.lit(0.0)).alias("__s"))
    )
    met = _met(points, ["__w"], k, features).withColumn("__nearer", _nearer("__w", features))
    sums = met.filter(F.col("__nearer") < k).groupBy(*features).agg(F.sum("__s").alias("__s"), F.sum("__w").alias("__w"))
    means = sums.select(*features, (F.col("__s") / F.nullif("__w", F.lit(0))).alias("knn"))
    return groups.join(means, list(features), "left").select(*groups.columns, "knn")


def _drawn(groups: DataFrame, features: Sequence[str], resamples: int) -> DataFrame:
    """``groups`` with ``__drawn``: how often each resample draws it, by salted hashes."""
    placed = numbered(groups, features, "place")
    size = F.lit(max(placed.count(), 1))
    number = hash_number(F.concat_ws("|", F.lit("boot"), "resample", "place"))
    draws = placed.select("place", F.explode(F.sequence(F.lit(1), F.lit(resamples))).alias("resample"))
    draws = draws.select("resample", F.pmod(number, size).alias("place"))
    times = [F.count_if(F.col("resample") == r) for r in range(1, resamples + 1)]
    counts = draws.groupBy("place").agg(F.array(*times).alias("__drawn"))
    never = F.array_repeat(F.lit(0).cast("bigint"), resamples)
    return placed.join(counts, "place", "left").withColumn("__drawn", F.coalesce("__drawn", never))


def k_errors(
    groups: DataFrame,
    grid: Sequence[int] = K_GRID,
    resamples: int = RESAMPLES,
    features: Sequence[str] = FEATURES,
    target: str = "b",
) -> DataFrame:
    """``(k, rmse)``: mean over bootstrap resamples of the error on the groups not drawn.

    Draws are salted hashes, so the result is reproducible.  A group drawn twice counts as two
    neighbours.  No bag is built: a place gets one list of neighbours, long enough for every resample, and a
    resample is a weight of each point in it.
    """
    most = max(grid)
    usable = groups.filter(_known(features) & F.col(target).isNotNull()).select(*features, F.col(target).alias("__b"))
    drawn = _drawn(usable, features, resamples)

    def each(text: str) -> Column:
        """An array with the expression for the draws ``{d}`` of every resample."""
        return F.expr(f"array({', '.join(text.replace('{d}', f'__drawn[{r}]') for r in range(resamples))})")

    points = drawn.groupBy(*features).agg(
        each("sum({d})").alias("__w"), each("sum({d} * __b)").alias("__s"), each("min({d}) = 0").alias("__out")
    )
    met = _met(points, [f"__w[{r}]" for r in range(resamples)], most, features, ["__out"])
    bags = F.arrays_zip(F.col("__out").alias("out"), F.col("__w").alias("w"), F.col("__s").alias("s"))
    near = met.select(*features, "__d2", F.posexplode(bags).alias("resample", "__bag"))
    near = near.select(*features, "__d2", "resample", "__bag.*").filter("out AND w > 0")
    near = near.withColumn("nearer", _nearer("w", [*features, "resample"]))
    guesses = near.filter(F.col("nearer") < most).groupBy(*features, "resample").agg(
        *[F.expr(f"sum(s) FILTER (WHERE nearer < {k}) / sum(w) FILTER (WHERE nearer < {k}) AS k_{k}") for k in grid]
    )
    slots = drawn.select(*features, "__b", F.posexplode("__drawn").alias("resample", "times")).filter("times = 0")
    errors = slots.join(guesses, [*features, "resample"]).groupBy("resample").agg(
        *[F.expr(f"sqrt(avg(pow(k_{k} - __b, 2))) AS k_{k}") for k in grid]
    )
    means = ", ".join(f"struct({k} AS k, avg(k_{k}) AS rmse)" for k in grid)
    return errors.agg(F.expr(f"array({means})").alias("tried")).select(F.inline("tried")).filter("rmse IS NOT NULL")


def choose_k(groups: DataFrame, **settings) -> DataFrame:
    """One row: the ``k`` with the lowest error, the smaller one if two are equal."""
    return k_errors(groups, **settings).orderBy("rmse", "k").limit(1)
