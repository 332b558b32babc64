"""The registered query of each operator, over its whole table, and the SQL twins of those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residua.llm import (
    langid, licenses, minhash, mixing, packing, periodic, prefix_trie, suffixes, token_counts, toxicity,
    vector_graph, vptree, wrapper,
)

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def workers_find_package(spark: SparkSession) -> None:
    """Python workers on this machine import the package from here; a cluster gets it with ``--py-files``."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    workers_find_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vector_graph.near_vectors(table(spark, folder, "embeddings"))


def token_count(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"))


def near_documents(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).withColumn("p", F.round("p", 9))


def repeats(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, folder, "documents"))


def languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    third = F.crc32(F.col("doc_id").cast("string")) % 3
    langs, chance = langid.fitted(docs, "crc32(CAST(doc_id AS STRING)) % 3 <> 1")
    predicted = langid.predictor(spark, langs, chance)("text")
    held_out = F.coalesce(third == 1, F.lit(False)).alias("held_out")
    return docs.select("doc_id", held_out, predicted.alias("p")).select("doc_id", "held_out", "p.*")


def license_labels(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(table(spark, folder, "documents")).drop("expressions")


def main_texts(spark: SparkSession, folder: str) -> DataFrame:
    return wrapper.page_texts(table(spark, folder, "pages")).drop("host")


def neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return vptree.nearest(table(spark, folder, "embeddings"), "id % 50 = 0", k=5, factor=1.0)


def packed(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return packing.pack(docs.select("doc_id", packing.word_count(F.col("text")).alias("n_tokens")))


def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return periodic.digests(periodic.periodic_runs(docs, rebuild=periodic.repeated_tail))


def toxic_texts(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxicity.toxicity(docs, labels, held_out="crc32(CAST(doc_id AS STRING)) % 5 = 0")[0]


def conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    paths = prefix_trie.with_lent_turns(prefix_trie.paths_of(table(spark, folder, "conversations")))
    return prefix_trie.digests(*prefix_trie.prefix_trie(paths))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_near_vectors": near_vectors,
        "op2_token_counts": token_count,
        "op3_near_documents": near_documents,
        "op4_mixing": mixture,
        "op5_repeated_passages": repeats,
        "op6_languages": languages,
        "op7_licenses": license_labels,
        "op8_main_texts": main_texts,
        "op9_neighbours": neighbours,
        "op10_packing": packed,
        "op11_periodic_runs": periodic_runs,
        "op12_toxicity": toxic_texts,
        "op13_prefix_trie": conversation_trie,
    }


def all_sql() -> dict[str, str]:
    return {"op4_mixing": mixing.sql(), "op10_packing": packing.sql()}
