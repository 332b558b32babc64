"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.session import stored


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id that occurs in ``links`` (two id columns a, b); component: the smallest id.

    Each round hangs the neighbours of every id on the smallest of them, until nothing moves: about
    log(n) rounds, each two aggregates and two joins of the link table.  The minima are aggregated before they
    are shuffled and are joined with one row per id, so a centre of very many links can be split.
    Links with a null end, and links of an id with itself, count as absent.
    """
    now = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    mark = _mark(now)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        hung = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(hung.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    hung = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return hung.union(now.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
