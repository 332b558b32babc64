"""Session for tests and benchmarks, and the shared folder that intermediate tables go to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("residua")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or what ``setCheckpointDir`` was given."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def new_path(spark: SparkSession, label: str) -> str:
    folder = _scratch.get() or f"{shared_folder(spark)}/residua/{spark.sparkContext.applicationId}"
    return f"{folder}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Tables stored inside go to a folder of their own in the shared one, which is removed at the end, also after an error."""
    folder = new_path(spark, "scratch")
    token = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


ROWS_PER_PART = 100_000  # of a shuffle whose tasks must not grow with the table


def parts_for(rows: int) -> int:
    """The number of parts that ``rows`` rows are dealt to, so that a part's size does not depend on the table's."""
    return max(1, -(-rows // ROWS_PER_PART))


def beyond_session(df: DataFrame, parts: int) -> bool:
    """Whether that many parts are more than a shuffle of the session has."""
    return parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dealt(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """``df`` by ``keys`` in that many parts, if they are more than the session's, else as it is and left to Spark."""
    return df.repartition(parts, *keys) if beyond_session(df, parts) else df


def stored(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage like a reliable checkpoint does, survives lost executors, and unlike a
    checkpoint stays columnar: later stages prune columns, and the size is known to the optimizer.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
