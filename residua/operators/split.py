"""Reproducible stratified hold-outs of an exact size, and their repair.

The held-out rows of a stratum are the first ``ceil(p * n)`` of its hash order.  That is the same
as "hash at or below a cutoff", so once the cutoff of each stratum is known, marking rows is a
plain row expression: nothing is ranked, sorted or shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residua.operators.quantiles import quantiles
from residua.operators.ranks import hash_order, prefix_digits, running_count
from residua.session import stored

QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)  # fixed values: strata are cut at these quantiles
COPIES_PER_ROW = 100_000

TRAIN, TEST, REJECTED = "train", "test", "rejected"


@dataclass(frozen=True)
class Cutoff:
    """The last held-out hash of a stratum, and how many of the rows that share it are held out."""

    stratum: int
    hash: str
    take: int
    copies: int


def value_counts(df: DataFrame, target: str) -> DataFrame:
    return df.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count("*").alias("n"))


def strata_edges(df: DataFrame, target: str = "rating") -> tuple[list[float], int]:
    """The quantile edges with duplicates merged, and the row count."""
    edges, rows = quantiles(value_counts(df, target), target, QUARTILES)
    return sorted(set(edges)), rows


def stratum_of(target: str, edges: list[float]) -> Column:
    """The number of inner edges strictly below the value."""
    above = [F.when(F.col(target) > edge, 1).otherwise(0) for edge in edges[1:-1]]
    count = reduce(lambda a, b: a + b, above, F.lit(0))
    return F.when(F.col(target).isNotNull(), count)


def per_stratum(stratum: Column, values: dict[int, object]) -> Column:
    """The literal that belongs to the stratum."""
    return reduce(lambda c, item: c.when(stratum == item[0], F.lit(item[1])), values.items(), F)


def _cutoffs(rows: DataFrame, fraction: float, total: int) -> list[Cutoff]:
    """``rows`` has ``__stratum`` and ``__hash``."""
    digits = prefix_digits(total)
    prefix = F.substring("__hash", 1, digits)
    quota = F.ceil(F.lit(fraction) * F.col("total"))

    def holding(groups: DataFrame, order: str, wanted: Column) -> DataFrame:
        counted = running_count(groups, order, ["__stratum"]).withColumn("wanted", wanted)
        return counted.filter("below < wanted AND wanted <= below + n")

    by_prefix = rows.groupBy("__stratum", prefix.alias("prefix")).agg(F.count("*").alias("n"))
    borders = holding(by_prefix.filter("__stratum IS NOT NULL"), "prefix", quota).collect()
    if not borders:
        return []
    border = per_stratum(F.col("__stratum"), {b["__stratum"]: b["prefix"] for b in borders})
    rest = per_stratum(
        F.col("__stratum"), {b["__stratum"]: b["wanted"] - b["below"] for b in borders}
    )
    near = rows.filter(prefix == border)
    by_hash = near.groupBy("__stratum", "__hash").agg(F.count("*").alias("n"))
    return [
        Cutoff(r["__stratum"], r["__hash"], r["wanted"] - r["below"], r["n"])
        for r in holding(by_hash, "__hash", rest).collect()
    ]


def _split_copies(tied: DataFrame, take: int, columns: list[str]) -> DataFrame:
    """Holds out ``take`` of the rows of one hash.

    Rows of one hash are copies, so equal rows are counted, each count is divided, and the copies
    are written out again, a bounded number by each task.
    """
    groups = tied.groupBy(*columns).agg(F.count("*").alias("n"))
    counted = running_count(groups.withColumn("__row", F.struct(*columns)), "__row")
    held = F.greatest(F.lit(0), F.least(F.col("n"), F.lit(take) - F.col("below")))
    parts = counted.select(
        *columns,
        F.explode(
            F.array(
                F.struct(F.lit(True).alias("held_out"), held.alias("n")),
                F.struct(F.lit(False).alias("held_out"), (F.col("n") - held).alias("n")),
            )
        ).alias("part"),
    ).select(*columns, "part.*")
    chunks = parts.filter("n > 0").select(
        *columns,
        "held_out",
        "n",
        F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(COPIES_PER_ROW))).alias("start"),
    )
    size = F.least(F.lit(COPIES_PER_ROW), F.col("n") - F.col("start"))
    return (
        chunks.repartition("start", "held_out")
        .select(*columns, "held_out", F.explode(F.sequence(F.lit(1), size)).alias("copy"))
        .select(*columns, "held_out")
    )


def stratified_holdout(
    df: DataFrame,
    salt: str,
    fraction: float = 0.1,
    target: str = "rating",
    key: str = "rating_key",
) -> DataFrame:
    """``df`` with a boolean ``held_out``: exactly ``ceil(fraction * n)`` rows of every stratum.

    Reads ``df`` four times (edges, prefix counts, border prefixes, result), three of them for a
    handful of numbers; pass a stored table.
    """
    return _marked(df, salt, fraction, target, key)[0]


def _marked(df: DataFrame, salt: str, fraction: float, target: str, key: str) -> tuple[DataFrame, bool]:
    """The marked rows, and whether the mark is an expression of the row alone."""
    edges, rows = strata_edges(df, target)
    stratum = stratum_of(target, edges)
    order = hash_order(salt, key)
    marked = df.select(stratum.alias("__stratum"), order.alias("__hash"))
    cutoffs = _cutoffs(marked, fraction, rows) if rows else []
    if not cutoffs:
        return df.withColumn("held_out", F.lit(False)), True

    last = per_stratum(stratum, {cut.stratum: cut.hash for cut in cutoffs})
    result = df.withColumn("held_out", F.coalesce(order <= last, F.lit(False)))
    tied = [cut for cut in cutoffs if cut.take < cut.copies]
    for cut in tied:
        at_cutoff = F.coalesce((stratum == cut.stratum) & (order == cut.hash), F.lit(False))
        result = result.filter(~at_cutoff).unionByName(
            _split_copies(df.filter(at_cutoff), cut.take, df.columns)
        )
    return result, not tied


def bernoulli_holdout(df: DataFrame, salt: str, fraction: float = 0.1, key: str = "rating_key") -> DataFrame:
    """``df`` with a boolean ``held_out`` that is true with the given chance: approximate size, one pass."""
    limit = format(int(fraction * 16**13), "013x")
    return df.withColumn("held_out", F.substring(hash_order(salt, key), 1, 13) < limit)


KEYS = ("item_id", "user_id")


def key_counts(rows: DataFrame, place: Column, places: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """``(kind, key, n_0, n_1, ...)``: per key how many of its rows are in each place; ``kind`` says which key it is.

    One pass over the rows for all keys, summed up before anything is shuffled.
    """
    kind = key_type(rows, keys)
    either = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(k).cast(kind).alias("key")) for i, k in enumerate(keys)])
    counts = [F.count_if(F.col("place") == i).alias(f"n_{i}") for i in range(places)]
    return rows.select(place.alias("place"), F.inline(either)).groupBy("kind", "key").agg(*counts)


def key_type(rows: DataFrame, keys: Sequence[str]) -> str:
    """A type that tells all keys apart."""
    whole = all(isinstance(rows.schema[k].dataType, T.IntegralType) for k in keys)
    return "bigint" if whole else "string"


def lost_keys(held: str, train: Sequence[str]) -> Column:
    """Over key counts: keys of rows in place ``held`` that no row of the ``train`` places has; no row knows a null key."""
    known = reduce(lambda a, b: a + b, [F.col(c) for c in train])
    return (F.col(held) > 0) & (F.col("key").isNull() | (known == 0))


def with_lost(rows: DataFrame, lost: DataFrame, name: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """``rows`` with a boolean column: has the row a key that is in ``lost``, or a null one?"""
    columns, type_ = rows.columns, key_type(rows, keys)
    unknown = F.lit(False)
    for i, key in enumerate(keys):
        kind = lost.filter((F.col("kind") == i) & F.col("key").isNotNull())
        kind = kind.select(F.col("key").alias(f"__lost_{i}"))
        rows = rows.join(kind, F.col(key).cast(type_) == F.col(f"__lost_{i}"), "left")
        unknown = unknown | F.col(f"__lost_{i}").isNotNull() | F.col(key).isNull()
    return rows.select(*columns, unknown.alias(name))


def judged(
    train: DataFrame,
    held_out: DataFrame,
    return_rejected: bool,
    item: str = "item_id",
    user: str = "user_id",
) -> DataFrame:
    """The held-out rows with ``fold``.

    A held-out row is a test row only if its item and its user both occur among the train rows.
    The others go back to train, or are labelled rejected.
    """
    keys = (item, user)
    both = train.select(*keys, F.lit(0).alias("side")).unionByName(held_out.select(*keys, F.lit(1).alias("side")))
    lost = key_counts(both, F.col("side"), 2, keys).filter(lost_keys("n_1", ["n_0"]))
    fold = F.when(~F.col("__lost"), TEST).otherwise(TRAIN if return_rejected else REJECTED)
    return with_lost(held_out, lost, "__lost", keys).select(*held_out.columns, fold.alias("fold"))


def split(
    df: DataFrame,
    salt: str,
    fraction: float = 0.1,
    return_rejected: bool = False,
    target: str = "rating",
    key: str = "rating_key",
) -> DataFrame:
    """Stratified hold-out and repair: ``df``, a stored table, with ``fold``.

    Known keys come from one table of rows per key and side: a key is known in train if it has rows that are not
    held out.  Usually no held-out row has an unknown key; then the fold is a comparison of the row's hash
    with a literal and nothing is joined or written.  Else the held-out tenth is joined with the lost keys and stored.
    (Where copies of one row stand at a cutoff, some of them are held out and others not; then the mark is stored.)
    """
    marked, plain = _marked(df, salt, fraction, target, key)
    if not plain:
        marked = stored(marked, f"{salt}-marked", ["held_out"])
    counts = key_counts(marked, F.col("held_out").cast("int"), 2)
    lost = stored(counts.filter(lost_keys("n_1", ["n_0"])), f"{salt}-lost")
    if lost.isEmpty():
        return marked.select(*df.columns, F.when(F.col("held_out"), TEST).otherwise(TRAIN).alias("fold"))
    train = marked.filter(~F.col("held_out")).drop("held_out")
    fold = F.when(~F.col("__lost"), TEST).otherwise(TRAIN if return_rejected else REJECTED)
    held_out = with_lost(marked.filter("held_out").drop("held_out"), lost, "__lost")
    verdict = stored(held_out.select(*df.columns, fold.alias("fold")), f"{salt}-judged", ["fold"])
    return train.withColumn("fold", F.lit(TRAIN)).unionByName(verdict)


@dataclass(frozen=True)
class NestedSplit:
    """Three nested 90/10 splits, each a table with a ``fold`` column.

    ``outer`` cuts all rows, ``inner`` cuts the train rows of ``outer``, ``tuning`` those of
    ``inner``.  Only the outer split gives rejected rows back.
    """

    outer: DataFrame
    inner: DataFrame
    tuning: DataFrame

    @staticmethod
    def _fold(df: DataFrame, fold: str) -> DataFrame:
        return df.filter(F.col("fold") == fold).drop("fold")

    @property
    def development(self) -> DataFrame:
        return self._fold(self.outer, TRAIN)

    @property
    def validation(self) -> DataFrame:
        return self._fold(self.outer, TEST)

    @property
    def train(self) -> DataFrame:
        return self._fold(self.inner, TRAIN)

    @property
    def test(self) -> DataFrame:
        return self._fold(self.inner, TEST)

    @property
    def tune_train(self) -> DataFrame:
        return self._fold(self.tuning, TRAIN)

    @property
    def tune_test(self) -> DataFrame:
        return self._fold(self.tuning, TEST)
