"""Line dedup by sorted hashes and keep bitmaps.

Lines become short rows (hash, document, position). They are range-partitioned by hash and
sorted by document and position within it; one pass over the sorted rows sees the first
occurrence of a hash and every later one. What comes back is no text but, per document, the
bits of its dropped lines, with words of 64 lines that lose none left out. Only the last step
reads texts again, and only to apply those bits.

A hash that holds much of all rows would fill one partition. Rows are therefore counted in
65,536 cells of the hash first; cells with over a thousandth of all rows, at most a thousand,
are decided by sums that combine before they shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.common import ascii_lower, fresh, named, whole
from storeledger.staging import lookup, materialise

_BLANKS = " \t\n\x0b\x0c\r"
_HOT_SHARE = 1000  # a hash cell with more than this part of all lines, or more lines
_HOT_ROWS = 1 << 20  # than this, is decided by sums


def lines_of(text: Column) -> Column:
    return F.split(whole(text), "\n")


def _row(text: Column) -> Column:
    """Tells apart rows that share an id."""
    return F.hash(whole(text))


def _line_rows(docs: DataFrame, id_column: str, text_column: str, min_chars: int) -> DataFrame:
    rows = docs.select(
        named(id_column).alias("doc_id"), _row(named(text_column)).alias("row"),
        F.posexplode(lines_of(named(text_column))).alias("position", "line"),
    )
    key = ascii_lower(F.btrim("line", F.lit(_BLANKS)))
    keyed = rows.select("doc_id", "row", "position", key.alias("key"))
    # 96 bits of hash stand for the key
    return keyed.where(F.char_length("key") >= min_chars).select(
        F.xxhash64("key").alias("a"), F.hash(F.lit(1), "key").alias("b"),
        "doc_id", "row", "position",
    )


def _streamed(lines: DataFrame, min_docs: int) -> DataFrame:
    """Lines to drop, from rows sorted by hash, document (largest first) and position."""
    newest_first = F.col("doc_id").desc_nulls_last()
    ordered = lines.repartitionByRange("a", "b").sortWithinPartitions(
        "a", "b", newest_first, "position"
    )
    same = Window.partitionBy("a", "b")
    seen = ordered.withColumn("nth", F.dense_rank().over(same.orderBy(newest_first)))
    counted = seen.withColumn("docs", F.max("nth").over(same))
    return counted.where((F.col("docs") >= min_docs) & (F.col("nth") > 1)).select(
        "doc_id", "row", "position"
    )


def _summed(lines: DataFrame, min_docs: int) -> DataFrame:
    """The same for few, very frequent hashes: sums first, rows joined to them after."""
    cut = (
        lines.groupBy("a", "b", "doc_id").agg(F.lit(1).alias("one"))
        .groupBy("a", "b").agg(F.count("*").alias("docs"), F.max("doc_id").alias("newest"))
        .where(F.col("docs") >= min_docs)
    )
    return (
        lookup(lines, cut, ["a", "b"], "inner")
        .where(~F.col("doc_id").eqNullSafe(F.col("newest")))
        .select("doc_id", "row", "position")
    )


def line_bitmaps(
    docs: DataFrame,
    *,
    min_chars: int = 20,
    min_docs: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Bits of the lines to drop, one row per document that loses a line.

    A line's key is the line without blanks at its ends, A to Z lower-cased. Keys of at least
    ``min_chars`` characters in at least ``min_docs`` documents lose all lines but those of the
    largest id that holds them. Returns ``doc_id, row`` (hash of the text, for ids that occur
    with several texts), ``drops``: array of (word, bits), bit ``i`` of word ``w`` for line
    ``64 * w + i``. A null id counts as one document, smaller than any other.
    """
    lines = materialise(_line_rows(docs, id_column, text_column, min_chars), "lines")
    cell = F.shiftrightunsigned("a", 48)
    counts = lines.groupBy(cell.alias("cell")).agg(F.count("*").alias("rows"))
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("all_rows"))
    hot = materialise(
        counts.join(F.broadcast(total)).where(
            (F.col("rows") * _HOT_SHARE > F.col("all_rows")) | (F.col("rows") > _HOT_ROWS)
        ),
        "hot-lines",
    )
    hot = F.broadcast(hot.select(F.col("cell").alias("hot")))  # at most 65,536 cells
    dropped = _streamed(lines.join(hot, cell == F.col("hot"), "left_anti"), min_docs).unionByName(
        _summed(lines.join(hot, cell == F.col("hot"), "left_semi"), min_docs)
    )
    word = F.floor(F.col("position") / 64).cast("int")
    bit = F.expr("shiftleft(1L, position % 64)")
    return (
        dropped.groupBy("doc_id", "row", word.alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .groupBy("doc_id", "row")
        .agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("drops"))
    )


def _kept(lines: Column, drops: Column) -> Column:
    by_word = F.map_from_entries(drops)
    words = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / 64).cast("int")),
        lambda w: F.coalesce(F.element_at(by_word, w), F.lit(0).cast("long")),
    )
    return F.transform(
        F.filter(
            F.arrays_zip(
                lines.alias("line"),
                F.flatten(
                    F.transform(
                        words,
                        lambda w: F.transform(
                            F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit(w, i)
                        ),
                    )
                ).alias("drop"),
            ),
            lambda x: x["line"].isNotNull() & (x["drop"] == 0),
        ),
        lambda x: x["line"],
    )


def drop_lines(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **how
) -> DataFrame:
    """``docs`` with repeated lines taken out of the text, all other columns kept.

    Adds ``n_lines`` and ``n_dropped`` (under other names if taken). A null text stays null and
    counts as one empty line; an empty table stays empty.
    """
    doc, row, drops = (fresh(docs, x) for x in ("line_doc", "line_row", "line_drops"))
    lines, dropped = fresh(docs, "n_lines"), fresh(docs, "n_dropped")
    bitmaps = line_bitmaps(docs, id_column=id_column, text_column=text_column, **how)
    bitmaps = materialise(bitmaps.toDF(doc, row, drops), "bitmaps")
    text = named(text_column)
    # always a merge join: the bitmaps grow with the input, so they are never broadcast
    joined = docs.join(
        bitmaps.hint("merge"),
        named(id_column).eqNullSafe(F.col(doc)) & (_row(text) == F.col(row)),
        "left",
    )
    bits = F.aggregate(
        F.col(drops), F.lit(0).cast("long"), lambda n, x: n + F.bit_count(x["bits"])
    )
    kept = F.when(F.col(drops).isNull(), text).otherwise(
        F.array_join(_kept(lines_of(text), F.col(drops)), "\n")
    )
    others = [named(c) if c != text_column else kept.alias(c) for c in docs.columns]
    return joined.select(
        *others, F.size(lines_of(text)).cast("long").alias(lines),
        F.coalesce(bits, F.lit(0).cast("long")).alias(dropped),
    )
