"""Saved tables: one Parquet directory each, and quick looks at them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.partitionBy(*partition_by).parquet(path)


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def peek(df: DataFrame, order: Sequence[str], rows: int = 6) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order).limit(rows)


def row_counts(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n"))
