"""Three nested stratified hold-outs from one table of counts.

Whether a row is held out on a level depends on its value and on its salted hash.  The cutoff of a stratum lies
near the wanted fraction, so of most rows it is enough to know on which side of a narrow band around
the fraction their hash is.  One scan counts rows by value and by side of the band on every level, and keeps apart
the few rows that are in a band on some level, with their hashes.  That table can be merged from parts of the data, and the
edges, quotas and cutoffs of all three levels follow from it: a level's population is the table
without what the level above holds out.

A second scan counts the rows of every item and user by place; a key is known in train if something is left after taking
away what is held out.  Usually every key is.  Else rows with unknown keys get their places anew: where the outer split gives
rows back, the inner levels are cut and counted again with those rows.  The lost keys, few as a rule, are stored, so that Spark
knows how small they are.  A last scan writes all rows, once and unsorted, with their place as a column: parting them by place
would sort all rows of a task, which spills where tasks are large.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residua.operators.quantiles import in_value_parts, quantiles_of_parts
from residua.operators.ranks import hash_order, running_count
from residua.operators.split import (
    QUARTILES,
    REJECTED,
    TEST,
    TRAIN,
    NestedSplit,
    key_counts,
    lost_keys,
    per_stratum,
    split,
    stratum_of,
    with_lost,
)
from residua.session import stored

SALTS = ("outer", "inner", "tuning")
BELOW, BAND, ABOVE = 0, 1, 2
WIDTH = 6.0  # half a band, in standard errors of the share of a stratum with a tenth of the rows
DIGITS = 13

VALIDATION, INNER_TEST, INNER_REJECTED = "validation", "test", "rejected"
TUNE_TEST, TUNE_REJECTED, TUNE_TRAIN = "tune_test", "tune_rejected", "tune_train"


@dataclass(frozen=True)
class Level:
    """The cut of one level: inner edges of the strata and the last held-out hash of each."""

    number: int
    edges: list[float]
    last: dict[int, str]

    def _held(self, target: str, order: Column) -> Column:
        if not self.last:
            return F.lit(False)
        cutoff = per_stratum(stratum_of(target, self.edges), self.last)
        return F.coalesce(order <= cutoff, F.lit(False))

    def held(self, target: str, key: str) -> Column:
        """Of a row: is it held out, if it is in the level's population?"""
        return self._held(target, hash_order(SALTS[self.number], key))

    def held_counted(self, target: str) -> Column:
        """The same of a row of the table of counts."""
        if not self.last:
            return F.lit(False)
        side = F.col(f"side_{self.number}")
        known = stratum_of(target, self.edges).isin(*self.last)
        return F.when(side == BAND, self._held(target, F.col(f"hash_{self.number}"))).otherwise((side == BELOW) & known)


def _limits(rows: int, fraction: float) -> tuple[str, str]:
    """The first digits of the hashes at which the band begins and ends."""
    half = WIDTH * math.sqrt(10 * max(fraction * (1 - fraction), 1e-6) / max(rows, 1))
    whole = 16**DIGITS

    def digits(share: float) -> str:
        return format(min(max(int(share * whole), 0), whole), f"0{DIGITS}x")

    # "g" is above every hash
    return digits(fraction - half), digits(fraction + half) if fraction + half < 1 else "g"


def band_counts(df: DataFrame, limits: tuple[str, str], target: str, key: str) -> DataFrame:
    """``(value, side_0.., hash_0.., n)``; the hashes are NULL for rows that are in no band."""
    low, high = limits
    hashes = [hash_order(salt, key).alias(f"hash_{i}") for i, salt in enumerate(SALTS)]
    rows = df.filter(F.col(target).isNotNull()).select(target, *hashes)
    head = [F.substring(f"hash_{i}", 1, DIGITS) for i in range(len(SALTS))]
    sides = [F.when(h < low, BELOW).when(h < high, BAND).otherwise(ABOVE).alias(f"side_{i}") for i, h in enumerate(head)]
    sided = rows.select(target, *[f"hash_{i}" for i in range(len(SALTS))], *sides)
    near = F.greatest(*[(F.col(f"side_{i}") == BAND).cast("int") for i in range(len(SALTS))]) == 1
    kept = [F.when(near, F.col(f"hash_{i}")).alias(f"hash_{i}") for i in range(len(SALTS))]
    groups = [target, *[f"side_{i}" for i in range(len(SALTS))]]
    return sided.groupBy(*groups, *kept).agg(F.count("*").alias("n"))


def _cut(counts: DataFrame, number: int, fraction: float, target: str) -> Level | None:
    """The cut of a population; None if a cutoff lies outside the band, or within copies of one row."""
    edges, rows = quantiles_of_parts(counts, target, QUARTILES)
    edges = sorted(set(edges))
    if not rows:
        return Level(number, edges, {})
    side, own = F.col(f"side_{number}"), F.col(f"hash_{number}")
    # sides are digits, so this sorts as the hashes do
    order = F.concat(side.cast("string"), F.when(side == BAND, own).otherwise(""))
    groups = counts.groupBy(stratum_of(target, edges).alias("stratum"), order.alias("place")).agg(F.sum("n").alias("n"))
    counted = running_count(groups, "place", ["stratum"]).withColumn("wanted", F.ceil(F.lit(fraction) * F.col("total")))
    last: dict[int, str] = {}
    for r in counted.filter("below < wanted AND wanted <= below + n").collect():
        if r["place"][0] != str(BAND) or r["below"] + r["n"] != r["wanted"]:
            return None
        last[r["stratum"]] = r["place"][1:]
    return Level(number, edges, last)


def _place(levels: Sequence[Level], target: str, key: str, back: Column) -> Column:
    """0: train of all levels; 1, 2, 3: held out by that level.  ``back``: rows that the first gives back."""
    outer, inner, tuning = [level.held(target, key) for level in levels]
    return F.when(outer & ~back, 1).when(inner, 2).when(tuning, 3).otherwise(0)


TRAIN_OF = {"n_1": ["n_0", "n_2", "n_3"], "n_2": ["n_0", "n_3"], "n_3": ["n_0"]}


def _one_table(df: DataFrame, fraction: float, target: str, key: str) -> DataFrame | None:
    """All rows with their ``place``, stored; None if the table of counts does not tell the cutoffs."""
    limits = _limits(df.count(), fraction)
    counts = in_value_parts(band_counts(df, limits, target, key), target)

    def cuts(population: DataFrame, first: int) -> list[Level] | None:
        found = []
        for number in range(first, len(SALTS)):
            level = _cut(population, number, fraction, target)
            if level is None:
                return None
            found.append(level)
            population = population.filter(~level.held_counted(target))
        return found

    def lost(keys: DataFrame, held: str) -> DataFrame:
        return stored(keys.filter(lost_keys(held, TRAIN_OF[held])).select("kind", "key"), "lost-keys")

    def losses_in(keys: DataFrame) -> dict[str, int]:
        return keys.agg(*[F.count_if(lost_keys(h, train)).alias(h) for h, train in TRAIN_OF.items()]).first().asDict()

    levels = cuts(counts, 0)
    if levels is None:
        return None
    rows, place = df, _place(levels, target, key, F.lit(False))
    keys = stored(key_counts(df, place, len(SALTS) + 1), "key-counts")
    losses = losses_in(keys)
    if losses["n_1"]:
        outer = levels[0]
        rows, back = with_lost(df, lost(keys, "n_1"), "__back"), F.col("__back")
        returned = band_counts(rows.filter(outer.held(target, key) & back), limits, target, key)
        rest = counts.drop("part").filter(~outer.held_counted(target)).unionByName(returned)
        inner = cuts(in_value_parts(rest, target), 1)
        if inner is None:
            return None
        place = _place([outer, *inner], target, key, back)
        keys = stored(key_counts(rows, place, len(SALTS) + 1), "key-counts")
        losses = losses_in(keys)
    refused = {}
    for held in ("n_2", "n_3"):
        refused[held] = F.lit(False)
        if losses[held]:
            rows, refused[held] = with_lost(rows, lost(keys, held), f"__refused_{held}"), F.col(f"__refused_{held}")
    name = _named(F.col("place"), refused["n_2"], refused["n_3"])
    return stored(rows.withColumn("place", place).select(*df.columns, name.alias("place")), "splits")


def _named(place: Column, refused_inner: Column, refused_tuning: Column) -> Column:
    return (
        F.when(place == 1, VALIDATION)
        .when(place == 2, F.when(refused_inner, INNER_REJECTED).otherwise(INNER_TEST))
        .when(place == 3, F.when(refused_tuning, TUNE_REJECTED).otherwise(TUNE_TEST))
        .otherwise(TUNE_TRAIN)
    )


def _folds(placed: DataFrame, of: Sequence[str], test: str, rejected: str) -> DataFrame:
    """One level's population with ``fold``."""
    fold = F.when(F.col("place") == test, TEST).when(F.col("place") == rejected, REJECTED).otherwise(TRAIN)
    return placed.filter(F.col("place").isin(*of)).withColumn("fold", fold).drop("place")


def level_by_level(
    df: DataFrame, fraction: float = 0.1, target: str = "rating", key: str = "rating_key"
) -> NestedSplit:
    """The same splits, each level cut from the rows of the one above."""

    def train(level: DataFrame) -> DataFrame:
        return level.filter(F.col("fold") == TRAIN).drop("fold")

    outer = split(df, SALTS[0], fraction, True, target, key)
    inner = split(train(outer), SALTS[1], fraction, False, target, key)
    tuning = split(train(inner), SALTS[2], fraction, False, target, key)
    return NestedSplit(outer, inner, tuning)


def nested_split(df: DataFrame, fraction: float = 0.1, target: str = "rating", key: str = "rating_key") -> NestedSplit:
    """Splits a stored table in three levels.

    Three scans: counts, keys, and the rows written once with their place.  Where so many rows share a hash that a cutoff is not
    in the band or falls between copies, the levels are cut one by one.
    """
    placed = _one_table(df, fraction, target, key)
    if placed is None:
        return level_by_level(df, fraction, target, key)
    tuning = (TUNE_TEST, TUNE_REJECTED, TUNE_TRAIN)
    inner = (INNER_TEST, INNER_REJECTED, *tuning)
    return NestedSplit(
        _folds(placed, (VALIDATION, *inner), VALIDATION, ""),
        _folds(placed, inner, INNER_TEST, INNER_REJECTED),
        _folds(placed, tuning, TUNE_TEST, TUNE_REJECTED),
    )
