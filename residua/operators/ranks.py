"""Rows at given ranks of a hash order, without sorting all rows.

A salted MD5 of the row key orders rows at random but reproducibly.  To find the row at a rank,
rows are counted per hash prefix; only rows in the prefix that holds the rank are looked at
closer.  With about sqrt(n) prefixes both steps touch about sqrt(n) rows after their aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residua.session import stored


def hash_order(salt: str, *key: str | Column) -> Column:
    """32 lower-case hexadecimal digits."""
    return F.md5(F.concat_ws("|", F.lit(salt), *key))


def hash_number(text: Column) -> Column:
    """60 bits of the MD5 as a BIGINT."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def prefix_digits(rows: int) -> int:
    """Hexadecimal digits that make about sqrt(rows) prefixes."""
    return max(1, math.ceil(math.log(max(rows, 1), 16) / 2))


def running_count(groups: DataFrame, order: str, within: Sequence[str] = ()) -> DataFrame:
    """Adds ``below``, the rows in all groups before this one, and ``total``, the rows in all."""
    ordered = Window.partitionBy(*within).orderBy(order)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return groups.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn(
        "total", F.sum("n").over(Window.partitionBy(*within))
    )


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with its 0-based place in the given order, as column ``name``.

    Rows are sorted over all tasks; what one task adds up is one row count per part.  Stored, so that rows that
    are equal in the order keep their places.
    """
    parts = stored(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "sorted-parts")
    sizes = running_count(parts.groupBy("__part").agg(F.count("*").alias("n")), "__part")
    starts = sizes.select("__part", F.col("below").alias("__start"))
    row = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    place = (F.col("__start") + row - 1).cast("bigint")
    return stored(parts.join(starts, "__part").select(*df.columns, place.alias(name)), "numbered")


def keys_at_ranks(keys: DataFrame, key: str, salt: str, ranks: DataFrame, rows: int) -> DataFrame:
    """Rows of ``keys`` at the 0-based ranks listed in column ``rank``; a small table of ranks.

    ``keys`` holds ``rows`` distinct keys.
    """
    hashed = keys.withColumn("__hash", hash_order(salt, key)).withColumn(
        "__prefix", F.substring("__hash", 1, prefix_digits(rows))
    )
    prefixes = running_count(hashed.groupBy("__prefix").agg(F.count("*").alias("n")), "__prefix")
    # As-of join: walk prefixes and wanted ranks together, each rank takes the prefix it falls in.
    walk = Window.orderBy("__at", "__is_rank").rowsBetween(Window.unboundedPreceding, 0)
    marks = prefixes.select(
        F.col("below").alias("__at"), F.lit(0).alias("__is_rank"), "__prefix", "below"
    ).unionByName(
        ranks.select(F.col("rank").alias("__at"), F.lit(1).alias("__is_rank")).distinct(),
        allowMissingColumns=True,
    )
    wanted = (
        marks.withColumn("__prefix", F.last("__prefix", ignorenulls=True).over(walk))
        .withColumn("below", F.last("below", ignorenulls=True).over(walk))
        .filter("__is_rank = 1")
        .select("__prefix", (F.col("__at") - F.col("below") + 1).alias("__place"))
    )
    near = hashed.join(wanted.select("__prefix").distinct(), "__prefix", "left_semi")
    place = F.row_number().over(Window.partitionBy("__prefix").orderBy("__hash", key))
    return (
        near.withColumn("__place", place.cast("bigint"))
        .join(wanted, ["__prefix", "__place"], "left_semi")
        .select(*keys.columns)
    )
