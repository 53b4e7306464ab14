"""Document fingerprints: threshold-scaled sketches.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so it grows with the
document, and the sketches of two documents of any sizes can be compared: the share of one
sketch in the other estimates how much of the text is contained there. The union of two sketches
is the sketch of both texts. The smallest hash is kept where none is below the fraction, so only
a text without words has an empty sketch; that hash alone does not tell how much is contained.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.common import ascii_lower, let, named, whole, words
from storeledger.staging import materialise

_RANGE_BITS = 63
_ORDER = "doc_id"


def _hash(*parts: Column) -> Column:
    return F.xxhash64(*parts).bitwiseAND(F.lit((1 << _RANGE_BITS) - 1))


def sketch(text: Column, *, width: int = 5, fraction_bits: int = 3) -> Column:
    """Sorted hashes of the text's shingles of ``width`` words, one in ``2 ** fraction_bits``.

    Words are cut at ASCII blanks, A to Z lower-cased. A text of fewer words is one shingle; a
    null or empty text has an empty sketch.
    """
    found = F.transform(words(ascii_lower(whole(text))), lambda w: F.xxhash64(w))
    limit = 1 << (_RANGE_BITS - fraction_bits)

    def shingles(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - width)
        full = F.transform(starts, lambda i: _hash(*[F.get(hashes, i + k) for k in range(width)]))
        return F.when(F.size(hashes) >= width, full).when(
            F.size(hashes) > 0, F.array(_hash(hashes))
        ).otherwise(F.array().cast("array<bigint>"))

    def kept(every: Column) -> Column:
        below = F.filter(every, lambda h: h < limit)
        smallest = F.filter(F.array(F.array_min(every)), lambda h: h.isNotNull())
        return F.sort_array(F.array_distinct(F.concat(below, smallest)))

    return let(let(found, shingles), kept)


def _below(found: Column, fraction_bits: int) -> Column:
    """A sketch without a hash that is kept only because no other is."""
    return F.filter(found, lambda h: h < 1 << (_RANGE_BITS - fraction_bits))


def merged(a: Column, b: Column, *, fraction_bits: int = 3) -> Column:
    """The sketch of both texts together."""

    def kept(every: Column) -> Column:
        below = _below(every, fraction_bits)
        return F.when(F.size(below) > 0, below).otherwise(F.slice(every, 1, 1))

    return let(F.sort_array(F.array_union(a, b)), kept)


def containment(a: Column, b: Column, *, fraction_bits: int = 3) -> Column:
    """Estimated share of the first text's shingles that the second has; 1 for an empty one.

    Null where the first text is so short that it has no hash below the fraction.
    """

    def share(below: Column) -> Column:
        shared = F.size(F.array_intersect(below, b))
        return F.when(F.size(a) == 0, 1.0).when(F.size(below) > 0, shared / F.size(below))

    return let(_below(a, fraction_bits), share)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity; 1 for two texts without words."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, 1.0).otherwise(shared / union)


def as_text(found: Column) -> Column:
    """A sketch as a string: 16 hexadecimal digits per hash, in order."""
    digits = F.transform(found, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0"))
    return F.array_join(digits, "")


def _blocks(docs: DataFrame, blocks: int) -> DataFrame:
    """``docs`` with ``point``, the hash of the text, and ``block``: a number that grows along
    the order of ids, falling, nulls last, then points, falling.

    Blocks are cut at the quantiles of the ids. An id that several quantiles fall on is cut
    further by its points, and so are the rows without an id, so a hot id is many blocks.
    """
    cuts = docs.agg(
        F.percentile_approx(_ORDER, [i / blocks for i in range(1, blocks)], 10 * blocks)
    ).first()[0]
    bounds = F.array(*[F.lit(c) for c in sorted(cuts or [0])]).cast("array<bigint>")
    rank = F.lit(0.5) - F.col("point") / float(1 << 64)  # 0 for the largest point, below 1
    above = F.size(F.filter(bounds, lambda b: b > F.col(_ORDER)))
    here = F.size(F.filter(bounds, lambda b: b == F.col(_ORDER)))
    block = F.when(
        F.col(_ORDER).isNull(), blocks + F.least(F.floor(rank * blocks), F.lit(blocks - 1))
    ).otherwise(above + F.least(F.floor(rank * (here + 1)), here))
    return docs.withColumn("point", F.xxhash64("text")).withColumn("block", block.cast("int"))


def with_next(docs: DataFrame, **how) -> DataFrame:
    """Rows ``doc_id, text`` with their ``sketch``, and ``next_text, next_sketch`` of the next
    document.

    Next is the one with the next smaller id (a null id is the smallest); after the last comes
    the first. Rows that repeat an id follow each other by the hash of their text. Ids are dealt
    into blocks along their own order, so one sort of each block and one row per block give
    every neighbour, and each text moves once. An empty table gives none.
    """
    blocks = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _blocks(docs.select(_ORDER, "text"), blocks)
    first = materialise(
        rows.groupBy("block").agg(F.max(F.struct(_ORDER, "point")).alias("first"))
        .select("block", "first.*"),
        "block-heads",
    )  # one narrow row per block
    of = first.select(
        F.col("block").alias("of_block"), F.col(_ORDER).alias("of_id"),
        F.col("point").alias("of_point"),
    )
    heads = (
        rows.join(
            F.broadcast(of),
            (F.col("block") == F.col("of_block")) & (F.col("point") == F.col("of_point"))
            & F.col(_ORDER).eqNullSafe(F.col("of_id")),
            "left_semi",
        )
        .dropDuplicates(["block"])
        .select("block", F.col("text").alias("head_text"))
    )
    down = Window.partitionBy().orderBy("block")  # one row per block
    after = materialise(
        first.select(
            F.coalesce(
                F.lag("block").over(down), F.max("block").over(Window.partitionBy())
            ).alias("last_block"),
            F.col("block").alias("head_block"),
        ),
        "block-order",
    )
    heads = materialise(
        after.join(heads, F.col("head_block") == F.col("block")).select(
            F.col("last_block").alias("of_block"), "head_text"
        ),
        "block-texts",
    )
    # sketches of one text per block, made of the few rows that were written
    heads = materialise(
        heads.withColumn("head_sketch", sketch(F.col("head_text"), **how)), "block-sketches"
    )
    order = Window.partitionBy("block").orderBy(
        F.col(_ORDER).desc_nulls_last(), F.col("point").desc()
    )
    beside = rows.withColumn("sketch", sketch(F.col("text"), **how)).withColumn(
        "next", F.lead(F.struct("text", "sketch")).over(order)
    )
    last = F.col("next").isNull()
    return beside.join(heads, F.col("block") == F.col("of_block")).select(
        _ORDER, "text", "sketch",
        F.when(last, F.col("head_text")).otherwise(F.col("next.text")).alias("next_text"),
        F.when(last, F.col("head_sketch")).otherwise(F.col("next.sketch")).alias("next_sketch"),
    )


def fingerprints(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **how
) -> DataFrame:
    """``doc_id, text`` (null as empty) and ``sketch``, one row per row of ``docs``."""
    return _documents(docs, id_column, text_column).withColumn(
        "sketch", sketch(F.col("text"), **how)
    )


def _documents(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(
        named(id_column).cast("long").alias("doc_id"),
        whole(named(text_column)).alias("text"),
    )


def edited_pairs(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **how
) -> DataFrame:
    """Each document beside its edited text: the last third of its characters replaced by the
    first as many of the next document (see ``with_next``). A null text is empty; an empty
    table gives none."""
    paired = with_next(_documents(docs, id_column, text_column), **how)
    chars = F.char_length("text")
    third = F.floor(chars / 3).cast("int")
    edited = F.concat(
        F.substr("text", F.lit(1), chars - third), F.substr("next_text", F.lit(1), third)
    )
    return paired.withColumn("n_chars", chars.cast("long")).withColumn("edited", edited)
