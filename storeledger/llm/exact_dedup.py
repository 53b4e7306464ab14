"""Exact dedup by content-defined chunk recipes.

A text is cut into chunks where its own characters say so. Chunks get identifiers that are
verified on the chunk texts: no two different chunks of the table share one. A document is
then the ordered list of its chunk identifiers, some bytes per half thousand characters, and
only these lists are compared. Long texts are moved once, chunk by chunk, with repeated chunks
combined before the shuffle, and never as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.llm.common import fresh, named, whole
from storeledger.staging import lookup, materialise

# --- Fixed values: a chunk ends where words end and begin with these, or at the longest ---
_ENDS = "aeiou0358"
_CHUNK = rf"(?s).{{512,4096}}?(?<=[{_ENDS}] [{_ENDS}])|.{{1,4096}}"
_SEEDS = 8


def chunks(text: Column) -> Column:
    """The chunks of a text, in order; joined they are the text, an empty text has none.

    A chunk has 512 to 4096 characters, the last one may be shorter.
    """
    return F.regexp_extract_all(whole(text), F.lit(_CHUNK), F.lit(0))


def _identifier(chunk: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(chunk).alias("a"), F.xxhash64(F.lit(seed), chunk).alias("b"))


def _verified_seed(pieces: DataFrame) -> int:
    """A seed under which every identifier of the table stands for one chunk text."""
    for seed in range(_SEEDS):
        distinct = pieces.select(_identifier(F.col("chunk"), seed).alias("id"), "chunk").distinct()
        if distinct.groupBy("id").count().where("count > 1").isEmpty():
            return seed
    raise RuntimeError("chunk identifiers collide under every seed")


def exact_groups(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Groups of equal texts.

    Returns one row per document: ``doc_id, keep_id`` (the largest id of its group),
    ``group_size, kept, n_chunks, copies, text_sha256``. Texts are equal when identical; null
    counts as the empty text. Rows that repeat an id and a text are one document: they count in
    ``group_size`` and give one row with their number in ``copies``. A null id is smaller than
    any other. An empty table gives no rows.
    """
    pieces = docs.select(F.explode(chunks(named(text_column))).alias("chunk"))
    seed = _verified_seed(pieces)
    recipes = docs.select(
        named(id_column).alias("doc_id"),
        F.transform(chunks(named(text_column)), lambda c: _identifier(c, seed)).alias("recipe"),
        F.sha2(whole(named(text_column)), 256).alias("text_sha256"),
    )
    members = materialise(
        recipes.groupBy("doc_id", "recipe").agg(
            F.count("*").alias("copies"), F.min("text_sha256").alias("text_sha256")
        ),
        "recipes",
    )
    groups = (
        members.groupBy("recipe")
        .agg(
            F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"),
            F.count("*").alias("members"),
        )
        .where(F.col("members") > 1)
        .drop("members")
    )
    # a document alone in its group needs no partner; the rest is a small table of groups
    return lookup(members, groups, "recipe").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
        .alias("keep_id"),
        F.coalesce("group_size", "copies").alias("group_size"),
        F.coalesce(F.col("doc_id").eqNullSafe(F.col("keep_id")) | F.col("group_size").isNull(),
                   F.lit(False)).alias("kept"),
        F.size("recipe").cast("long").alias("n_chunks"), "copies", "text_sha256",
    )


def drop_copies(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    groups = exact_groups(docs, id_column=id_column, text_column=text_column)
    touched = groups.where(~F.col("kept") | (F.col("copies") > 1))
    doc, sha, kept = (fresh(docs, x) for x in ("dup_doc", "dup_sha", "dup_kept"))
    touched = materialise(
        touched.select(
            F.col("doc_id").alias(doc), F.col("text_sha256").alias(sha), F.col("kept").alias(kept)
        ),
        "copies",
    )
    text = F.sha2(whole(named(text_column)), 256)
    # only rows whose id was touched need their text hashed and compared
    # always a merge join: copies grow with the input, so they are never broadcast
    joined = docs.join(
        touched.hint("merge"),
        named(id_column).eqNullSafe(F.col(doc)) & (text == F.col(sha)),
        "left",
    )
    columns = [named(c) for c in docs.columns]
    alone = joined.where(F.col(kept).isNull()).select(*columns)
    repeated = joined.where(F.col(kept)).dropDuplicates([doc, sha]).select(*columns)
    return alone.unionByName(repeated)
