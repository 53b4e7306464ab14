"""From raw documents to packed training sequences.

Every stage takes what the one before it kept and returns rows with the columns of
``documents``; the last one returns the packed pieces. Stages hand over written tables, so a
lost executor costs at most the stage that is running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.llm import exact_dedup, language_id, mixing, near_join, packing
from storeledger.staging import materialise


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages; texts without letters go."""
    learned = docs.where(F.col("doc_id").isNotNull() & ~language_id.held_out())
    return language_id.keep_known(docs, language_id.train(learned))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shared five-word shingles, 0.8 or more alike."""
    return near_join.keep_one(docs, width=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document goes, stays, or is there twice."""
    return mixing.take(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids."""
    return packing.pack(
        docs, packing.public_vocabulary(),
        ranks=packing.public_vocabulary("byte_bpe_50k.tiktoken"),
    )


STAGES = [
    ("language ID", known_languages),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing sources", mixed),
    ("packing", packed),
]

# Neither the language model nor the components can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
