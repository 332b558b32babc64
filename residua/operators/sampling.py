"""Reproducible samples of keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.operators.ranks import hash_number, hash_order, keys_at_ranks


def draw_with_replacement(keys: DataFrame, key: str, times: int, salt: str) -> DataFrame:
    """The distinct keys among ``times`` draws; ``keys`` has one row per key."""
    one = keys.select(key)
    rows = one.count()
    draws = one.sparkSession.range(1, times + 1)
    rank = F.pmod(hash_number(F.concat_ws("|", F.lit(salt), "id")), F.lit(max(rows, 1)))
    return keys_at_ranks(one, key, salt, draws.select(rank.alias("rank")), rows)


def panels(keys: DataFrame, key: str, count: int, size: int, salt: str) -> DataFrame:
    """``(panel, key)``: in each panel ``size`` different keys; panels may share keys.

    Each panel is the head of its own hash order, which Spark takes as a top-k of every partition.
    """

    def panel(number: int) -> DataFrame:
        order = hash_order(f"{salt}|{number}", key)
        return keys.select(F.lit(number).alias("panel"), key).orderBy(order).limit(size)

    return reduce(DataFrame.unionByName, [panel(i) for i in range(1, count + 1)])
