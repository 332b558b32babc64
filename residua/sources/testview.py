"""The rating rows that stand in for the input files, made from the generated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residua.session import dealt, parts_for


def _title() -> F.Column:
    year = (1930 + (F.col("p_partkey") * 7) % 80).cast("string")
    return F.when(F.col("p_partkey") % 97 == 0, F.col("p_name")).otherwise(
        F.concat("p_name", F.lit(" ("), year, F.lit(")"))
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    part = spark.read.parquet(f"{folder}/part.parquet")
    words = F.split("p_name", " ")
    return part.select(
        F.col("p_partkey").alias("item_id"),
        _title().alias("title"),
        F.concat_ws("|", "p_type", words[0], words[1]).alias("tags"),
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey")
    parts = parts_for(lines.count())
    lines, orders = dealt(lines, parts, "l_orderkey"), dealt(orders, parts, "o_orderkey")
    ship = F.col("l_shipdate")
    epoch = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', l_shipdate)")
    key = F.md5(
        F.concat_ws(
            "|",
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.col("l_quantity").cast("bigint"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint"),
            F.unix_date(ship.cast("date")),
        )
    )
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        key.alias("rating_key"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        (F.ceil(F.col("l_quantity") / 5.0) / F.lit(2.0)).alias("rating"),
        epoch.alias("ts"),
    )


