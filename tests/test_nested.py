"""The nested split from one table of counts against the same cut level by level."""

import random

import pytest
from pyspark.sql import functions as F

from residua.operators import nested as N
from residua.operators.split import NestedSplit
from residua.session import stored

SCHEMA = "rating_key string, user_id long, item_id long, rating double, ts long"


def folds(split: NestedSplit):
    return {
        name: sorted((r["rating_key"], r["user_id"], r["item_id"], r["fold"]) for r in getattr(split, name).collect())
        for name in ("outer", "inner", "tuning")
    }


def table(spark, rows):
    return stored(spark.createDataFrame(rows, SCHEMA), "nested-test")


def sparse(n, items, users, seed=1, values=10):
    rng = random.Random(seed)
    return [
        (f"k{i}", rng.randrange(users), rng.randrange(items), rng.randrange(values) / 2, i) for i in range(n)
    ]


@pytest.mark.parametrize("n,items,users,values", [(3000, 20, 30, 10), (3000, 900, 700, 10), (4000, 15, 25, 4000)])
def test_same_as_level_by_level(spark, n, items, users, values):
    df = table(spark, sparse(n, items, users, values=values))
    assert N._one_table(df, 0.1, "rating", "rating_key") is not None
    got, expected = folds(N.nested_split(df)), folds(N.level_by_level(df))
    assert got == expected
    if items > 500:  # the case in which keys are lost on every level
        assert {f[3] for f in got["inner"]} == {f[3] for f in got["tuning"]} == {"train", "test", "rejected"}


@pytest.mark.parametrize("n", [0, 2, 60])
def test_few_rows(spark, n):
    df = table(spark, sparse(n, 4, 4))
    assert folds(N.nested_split(df)) == folds(N.level_by_level(df))


@pytest.mark.parametrize("fraction", [0.0, 0.5])
def test_fractions(spark, fraction):
    df = table(spark, sparse(500, 4, 4))
    assert folds(N.nested_split(df, fraction)) == folds(N.level_by_level(df, fraction))


def test_unknown_ratings_and_keys(spark):
    rows = sparse(2000, 30, 30)
    rows = [(k, None if i % 13 == 0 else u, None if i % 17 == 0 else t, None if i % 7 == 0 else r, ts) for i, (k, u, t, r, ts) in enumerate(rows)]
    df = table(spark, rows)
    got = N.nested_split(df)
    none = {name: getattr(got, name).filter("user_id IS NULL OR item_id IS NULL").groupBy("fold").count().collect() for name in ("outer", "inner")}
    assert {r["fold"] for r in none["outer"]} == {"train"} and {r["fold"] for r in none["inner"]} == {"train", "rejected"}
    assert got.validation.filter("rating IS NULL").count() == 0

    def text(split):
        return {n: sorted(map(str, getattr(split, n).collect())) for n in ("outer", "inner", "tuning")}

    assert text(got) == text(N.level_by_level(df))


def test_copies_of_one_row(spark):
    """A third of all rows are one row: where a cutoff falls between copies, the levels are cut one by one."""
    for seed in (2,):
        rows = sparse(1000, 5, 5, seed) + [("copy", 1, 1, 2.0, 0)] * 500
        df = table(spark, rows)
        got = folds(N.nested_split(df, 0.4))
        expected = folds(N.level_by_level(df, 0.4))
        assert got == expected


def test_rows_are_scanned_three_times(spark):
    rows = sparse(4000, 20, 20)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(key):
        seen.add(1)
        return key

    df = table(spark, rows).withColumn("rating_key", counted("rating_key"))
    kept = df.count
    seen.value = 0
    split = N.nested_split(df)
    assert kept() == 4000 and seen.value <= 3 * 4000
    assert split.outer.count() == 4000 and seen.value <= 3 * 4000


def test_rows_are_written_once_where_keys_are_lost(spark, monkeypatch):
    """Also not sorted by place; the lost keys are a stored table, whose size Spark knows."""
    written = []

    def spied(df, label, partition_by=()):
        written.append((label, tuple(partition_by)))
        return stored(df, label, partition_by)

    df = table(spark, sparse(3000, 900, 700))
    monkeypatch.setattr(N, "stored", spied)
    got = N.nested_split(df)
    assert [w for w in written if w[0] == "splits"] == [("splits", ())]
    assert "lost-keys" in {label for label, _ in written}
    assert {r["fold"] for r in got.inner.select("fold").distinct().collect()} == {"train", "test", "rejected"}
