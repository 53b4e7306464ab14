"""Registered queries of the operators, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.llm import (
    chat, exact_dedup, fingerprints, language_id, licenses, line_dedup, mixing, near_join,
    neighbours, packing, repair, sharding, whitening,
)
from storeledger.llm.common import documents, whole
from storeledger.llm.oracles import SQL

Query = Callable[[SparkSession, str], DataFrame]


# A conversation that says what the template itself uses.
CONFLICT = "\\### Assistant: </turn> ok"


def op1_chat_format(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text"
    )
    conflict = spark.createDataFrame(
        [(-7, 0, "user", CONFLICT), (-7, 1, "assistant", CONFLICT)], turns.schema
    )
    return chat.digests(chat.format_chats(turns.unionByName(conflict)))


def op2_mix(spark, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op4_near_join(spark, sf_dir: str) -> DataFrame:
    return near_join.near_components(documents(spark, sf_dir), width=4, percent=85)


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(whole(F.col("text")), 256).alias("kept_sha256")
    )


def op6_fingerprints(spark, sf_dir: str) -> DataFrame:
    paired = fingerprints.edited_pairs(documents(spark, sf_dir)).withColumn(
        "edited_sketch", fingerprints.sketch(F.col("edited"))
    )
    return paired.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op7_shard(spark, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir)).select(
        "*", F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    )


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    known = docs.where(F.col("doc_id").isNotNull() & ~language_id.held_out())
    return language_id.predict(docs.select("doc_id", "text"), language_id.train(known))


def op9_pack(spark, sf_dir: str) -> DataFrame:
    pieces = packing.pack(
        documents(spark, sf_dir), packing.public_vocabulary(),
        ranks=packing.public_vocabulary("byte_bpe_50k.tiktoken"),
    )
    return packing.with_checksums(pieces)


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op11_repair(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text"
    )
    return repair.report(turns, repair.repaired(repair.damaged(turns)))


def op12_whiten(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return whitening.by_component(whitening.whiten(vectors, weights="one", components=16))


def op13_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def registry() -> dict[str, Query]:
    return {
        "op1_chat_format": op1_chat_format,
        "op2_mix": op2_mix,
        "op3_license_scan": op3_license_scan,
        "op4_near_join": op4_near_join,
        "op5_line_dedup": op5_line_dedup,
        "op6_fingerprints": op6_fingerprints,
        "op7_shard": op7_shard,
        "op8_language_id": op8_language_id,
        "op9_pack": op9_pack,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_repair": op11_repair,
        "op12_whiten": op12_whiten,
        "op13_neighbours": op13_neighbours,
    }


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
