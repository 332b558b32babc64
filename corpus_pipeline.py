"""From raw documents to packed batches: five stages, each one operator, each written out before the next.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``.  All but the last return rows
in the columns of ``docs``; the last returns each document's place in the batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residua.llm import langid, minhash, mixing, packing, suffixes
from residua.llm.queries import workers_find_package
from residua.session import stored

#: A document is rejected if its likeliest language is less likely than all others together.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without a letter, or between languages, go.

    The model is learned from the labelled documents; where none is labelled, only those without a letter go.
    """
    workers_find_package(spark)
    langs, chance = langid.fitted(docs)
    if not langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    predicted = docs.withColumn("__language", langid.predictor(spark, langs, chance)("text"))
    good = (F.col("__language.lang_pred") != langid.UNDETERMINED) & (F.col("__language.score") >= LEAST_SCORE)
    return predicted.where(good).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; of rows that share a doc_id, the one with the least text stays."""
    workers_find_package(spark)
    found = minhash.near_duplicates(docs)
    gone = found.where("NOT keep").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = stored(docs.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select("doc_id"), "again")
    if again.isEmpty():
        return left
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = left.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("text", *rest)).alias("least"))
    once = rows.select("doc_id", "least.*").select(*docs.columns)
    return left.join(again, "doc_id", "left_anti").select(*docs.columns).union(once)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out; documents of which no word is left go."""
    workers_find_package(spark)
    spans = stored(suffixes.repeated_passages(docs), "spans")
    cut = suffixes.cut_repeats(docs, spans)
    touched = spans.select(F.col("doc_id").alias("__id")).distinct()
    both = cut.join(touched, F.col("doc_id") == F.col("__id"), "left")
    empty = F.col("__id").isNotNull() & ~F.col("text").rlike(r"[0-9A-Za-z\x{80}-\x{10FFFF}]")
    changed = {"n_chars": F.when(F.col("__id").isNotNull(), F.length("text")).otherwise(F.col("n_chars"))}
    columns = [changed[c].cast(docs.schema[c].dataType).alias(c) if c in changed else F.col(c) for c in docs.columns]
    return both.where(~F.coalesce(empty, F.lit(False))).select(*columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with the raked shares of sources, languages and topics."""
    workers_find_package(spark)
    return mixing.sampled(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's bucket, batch and slot."""
    return packing.pack(docs.select("doc_id", packing.word_count(F.col("text")).alias("n_tokens")))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixing", mixture),
    ("packing", packed),
]

#: The first stages learn, sample hashes and sort suffixes, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
