"""Ingest of ``::``-delimited rating and item files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residua.functions.scalar import number
from residua.schema import ITEMS, RATING_ROW, RATINGS

SEPARATOR = "::"
NOT_FINITE = tuple(float(x) for x in ("nan", "inf", "-inf"))


def parse_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Every line of a ratings file: ``value``, ``reason`` and the four fields.

    A line is read if it has four fields, all finite numbers: ``reason`` is NULL.  Else the reason is ``blank``, ``fields``
    (not four of them) or the name of the first field that is missing or no number, and all fields are NULL.
    """
    lines = spark.read.text(path).withColumn("__parts", F.split("value", SEPARATOR))
    typed = [number(F.get("__parts", F.lit(i)), f.dataType.simpleString()) for i, f in enumerate(RATINGS)]
    usable = [t.isNotNull() & ~t.cast("double").isin(*NOT_FINITE) for t in typed]
    reason = F.when(F.trim("value") == "", "blank").when(F.size("__parts") != len(RATINGS), "fields")
    for field, ok in zip(RATINGS, usable):
        reason = reason.when(~ok, field.name)
    told = lines.withColumn("reason", reason)
    return told.select("value", "reason", *[F.when(F.col("reason").isNull(), t).alias(f.name) for t, f in zip(typed, RATINGS)])


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a ratings file; with ``unreadable_ratings`` these are all its lines."""
    return parse_ratings(spark, path).filter("reason IS NULL").select(*RATINGS.names)


def unreadable_ratings(spark: SparkSession, path: str) -> DataFrame:
    """The lines that give no row, each with its reason."""
    return parse_ratings(spark, path).filter("reason IS NOT NULL").select("value", "reason")


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """At most three fields per line: the third keeps any further separator.

    The line is split as text, because a CSV reader would let a title that starts with a quote
    swallow the separator.
    """
    fields = F.split("value", SEPARATOR, 3)
    return spark.read.text(path).select(
        number(fields[0], "bigint").alias("item_id"),
        F.get(fields, 1).cast(ITEMS["title"].dataType).alias("title"),
        F.get(fields, 2).cast(ITEMS["tags"].dataType).alias("tags"),
    )


def write_delimited(df: DataFrame, path: str) -> None:
    """Write the columns of ``df`` in order, one ``::``-delimited line per row."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(SEPARATOR, *fields).alias("value")).write.text(path)


def with_key(ratings: DataFrame) -> DataFrame:
    """Adds ``rating_key`` from all fields; equal rows get equal keys and count as copies."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RATINGS.names]
    return ratings.withColumn("rating_key", F.md5(F.concat_ws("|", *fields))).select(*RATING_ROW)


def join_items(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Every rating with the title and tags of its item; unknown items keep NULLs."""
    return ratings.join(items, "item_id", "left")
