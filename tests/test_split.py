import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from residua.operators import split as S
from residua.operators.nested import nested_split
from residua.operators.joins import natural_anti_join, natural_left_join, with_known_keys
from residua.operators.quantiles import quantiles
from residua.operators.ranks import keys_at_ranks
from residua.session import stored
from residua.sources import testview


@pytest.fixture(scope="module")
def rows(spark, folder):
    return stored(testview.ratings(spark, folder), "test-rows")


def expected_holdout(keyed, edges, salt, fraction):
    """Plain ranking of (key, rating) pairs."""
    strata = {}
    for key, rating in keyed:
        stratum = sum(rating > e for e in edges[1:-1])
        strata.setdefault(stratum, []).append(hashlib.md5(f"{salt}|{key}".encode()).hexdigest())
    return {
        s: Counter(sorted(hashes)[: math.ceil(fraction * len(hashes))]) for s, hashes in strata.items()
    }


def test_holdout_is_the_head_of_the_hash_order(spark, rows):
    edges, _ = S.strata_edges(rows)
    assert edges == [0.5, 1.5, 2.5, 4.0, 5.0]
    marked = S.stratified_holdout(rows, "outer").collect()
    expected = expected_holdout([(r["rating_key"], r["rating"]) for r in marked], edges, "outer", 0.1)
    got = {s: Counter() for s in expected}
    for r in marked:
        if r["held_out"]:
            stratum = sum(r["rating"] > e for e in edges[1:-1])
            got[stratum][hashlib.md5(f"outer|{r['rating_key']}".encode()).hexdigest()] += 1
    assert got == expected


@pytest.mark.parametrize("count", [1, 2, 5, 1000])
def test_quantiles_over_parts_equal_those_of_one_task(spark, count):
    counts = spark.range(count).select(
        (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 7).alias("x"), (F.col("id") % 5 + 1).alias("n")
    )
    probs = [0.0, 0.1, 0.25, 0.5, 0.999, 1.0]
    wanted = F.array(*[F.lit(p) for p in probs])
    few, same = counts.agg(F.percentile("x", wanted, F.col("n")), F.sum("n")).first()
    many, rows = quantiles(counts, "x", probs)
    assert rows == same
    assert all(abs(a - b) < 1e-3 * 1e-3 for a, b in zip(few, many))


@pytest.mark.parametrize("fraction, held", [(0.0, 0), (1.0, 95)])
def test_fractions_at_the_ends(spark, fraction, held):
    rating = (F.col("id") % 7).cast("double").alias("rating")
    df = spark.range(95).select(F.col("id").cast("string").alias("rating_key"), rating)
    assert S.stratified_holdout(df, "s", fraction).filter("held_out").count() == held


def test_equal_ratings_make_one_stratum(spark):
    df = spark.range(95).select(F.col("id").cast("string").alias("rating_key"), F.lit(3.0).alias("rating"))
    assert S.strata_edges(df) == ([3.0], 95)
    assert S.stratified_holdout(df, "s").filter("held_out").count() == 10


def test_copies_are_divided_exactly(spark):
    """A third of all rows are copies of one row; the quota still holds and no row is lost."""
    many = spark.range(4000).select(F.col("id").cast("string").alias("rating_key"))
    for salt in ("a", "b", "c", "d", "e", "f"):
        df = many.unionByName(spark.range(2000).select(F.lit("copy").alias("rating_key"))).withColumn(
            "rating", F.lit(3.0)
        )
        out = S.stratified_holdout(df, salt, 0.4).groupBy("held_out").count().collect()
        assert {r["held_out"]: r["count"] for r in out} == {True: 2400, False: 3600}


def test_only_copies(spark):
    df = spark.range(1000).select(F.lit("copy").alias("rating_key"), F.lit(3.0).alias("rating"))
    marked = S.stratified_holdout(df, "x")
    assert marked.filter("held_out").count() == 100
    assert marked.count() == 1000


def test_unknown_ratings_are_never_held_out(spark):
    df = spark.range(100).select(
        F.col("id").cast("string").alias("rating_key"), F.when(F.col("id") < 50, 2.0).alias("rating")
    )
    out = S.stratified_holdout(df, "x")
    assert out.filter("held_out").count() == 5
    assert out.filter("rating IS NULL AND held_out").count() == 0
    assert out.count() == 100


def test_no_rows(spark):
    df = spark.createDataFrame([], "rating_key string, rating double")
    assert S.stratified_holdout(df, "x").count() == 0


def test_nested_split_is_disjoint_complete_and_known(spark, rows):
    s = nested_split(rows)
    everything = rows.count()
    assert s.development.count() + s.validation.count() == everything
    assert s.outer.select("rating_key").distinct().count() == everything
    for train, test in ((s.train, s.test), (s.tune_train, s.tune_test)):
        assert test.join(train, "item_id", "left_anti").count() == 0
        assert test.join(train, "user_id", "left_anti").count() == 0
        assert test.join(train, "rating_key", "left_semi").count() == 0
    assert s.inner.count() == s.development.count()
    assert s.tuning.count() == s.train.count()
    assert set(r["fold"] for r in s.outer.select("fold").distinct().collect()) <= {"train", "test"}


def judge(spark, return_rejected):
    train = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], "rating_key string, user_id int, item_id int")
    held = spark.createDataFrame(
        [("c", 1, 2), ("d", 1, 9), ("e", 9, 1)], "rating_key string, user_id int, item_id int"
    )
    return {r["rating_key"]: r["fold"] for r in S.judged(train, held, return_rejected).collect()}


def test_rows_with_unknown_keys_are_rejected_or_returned(spark):
    assert judge(spark, False) == {"c": "test", "d": "rejected", "e": "rejected"}
    assert judge(spark, True) == {"c": "test", "d": "train", "e": "train"}


def test_bernoulli_size_is_near_the_fraction(spark, rows):
    held = S.bernoulli_holdout(rows, "chance").filter("held_out").count()
    assert abs(held / rows.count() - 0.1) < 0.02


def test_partitioning_changes_nothing(spark, rows):
    a = S.stratified_holdout(rows, "outer").filter("held_out").select("rating_key")
    b = S.stratified_holdout(rows.repartition(13), "outer").filter("held_out").select("rating_key")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_known_keys(spark):
    train = spark.createDataFrame([(1, 10), (2, 20)], "user_id int, item_id int")
    test = spark.createDataFrame([(1, 20), (1, 30), (3, 10)], "user_id int, item_id int")
    assert [tuple(r) for r in with_known_keys(test, train, "item_id", "user_id").select("user_id", "item_id").collect()] == [(1, 20)]


def test_natural_joins_match_nulls(spark):
    x = spark.createDataFrame([(1, None), (1, None), (2, "a"), (3, "b")], "k int, s string")
    y = spark.createDataFrame([(1, None, 5), (2, "a", 6), (3, None, 7)], "k int, s string, v int")
    assert [tuple(r) for r in natural_anti_join(x, y).collect()] == [(3, "b")]
    joined = sorted(map(tuple, natural_left_join(x, y).collect()), key=str)
    assert joined == [(1, None, 5), (1, None, 5), (2, "a", 6), (3, "b", None)]
    plan = natural_left_join(x, y)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_keys_at_ranks(spark):
    keys = spark.range(500).select(F.col("id").alias("user_id"))
    order = sorted(range(500), key=lambda i: hashlib.md5(f"s|{i}".encode()).hexdigest())
    wanted = [0, 0, 1, 77, 250, 498, 499]
    ranks = spark.createDataFrame([(r,) for r in wanted], "rank bigint")
    got = {r["user_id"] for r in keys_at_ranks(keys, "user_id", "s", ranks, 500).collect()}
    assert got == {order[r] for r in wanted}
