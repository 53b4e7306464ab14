"""Packing by concatenating and cutting.

First pass: each task tokenizes its documents once, keeps a running sum of their lengths and
writes ids and local starts to a table. The totals of the tasks, one number each, are summed up
to global offsets. Second pass: a document's global start is its task's offset plus its local
start, and windows of fixed length are cut there. A piece that does not begin its document or
its window is a boundary record. Every sequence but the last is full.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.common import Recent, named, whole
from storeledger.staging import materialise

_TOKENS = "doc_id long, task int, start long, tokens int, ids binary"
_PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long,"
    " offset long"
)
# Word and the blanks before it. No token of the vocabulary crosses from a character that is no
# space into a blank, so the ids of a text are the ids of its cells, one after the other.
_CELL = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
# Characters for which both libraries split texts alike: ASCII and Latin letters. A text with
# any other character is encoded as a whole.
_PLAIN = re.compile(r"[ -~\nÀ-ÖØ-öø-ſ¿¡«»]*")
_CACHED = 200_000


class TextEncoder:
    """Ids of texts, as little-endian unsigned 32-bit numbers in bytes.

    ``ranks`` is the same vocabulary as merge ranks; with it plain texts are encoded word by
    word with a faster library, to the same ids.
    """

    def __init__(self, vocabulary: str, ranks: str | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content for token in added]
        self.cells = None
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(t): int(n) for t, n in map(bytes.split, lines)}
            plain = tiktoken.Encoding(
                "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges,
                special_tokens={},
            )
            self.cells = Recent(
                lambda cell: array("I", plain.encode_ordinary(cell)).tobytes(), _CACHED
            )

    def __call__(self, text: str) -> bytes:
        plain = self.cells is not None and _PLAIN.fullmatch(text)
        if not plain or any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype="<u4").tobytes()
        return b"".join(map(self.cells.__getitem__, _CELL.findall(text)))


def tokenize(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    *,
    ranks: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, task, start, tokens, ids``: ids of each text with the end id behind, where
    ``start`` counts the ids before it among the rows of its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, start = TextEncoder(vocabulary, ranks), np.array([end_id], "<u4").tobytes(), 0
        for batch in batches:
            doc, task, text = batch.columns
            for at in range(0, len(doc), 256):
                ids = [encode(t) + end for t in text.slice(at, 256).to_pylist()]
                counts = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                starts = start + np.concatenate([[0], np.cumsum(counts)[:-1]])
                start += int(counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        doc.slice(at, 256), task.slice(at, 256), pa.array(starts),
                        pa.array(counts.astype(np.int32)), pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "task", "start", "tokens", "ids"],
                )

    return docs.select(
        named(id_column).cast("long").alias("doc_id"), F.spark_partition_id().alias("task"),
        whole(named(text_column)).alias("text"),
    ).mapInArrow(run, _TOKENS)


def pack(
    docs: DataFrame,
    vocabulary: str,
    *,
    ranks: str | None = None,
    length: int = 2048,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Cut the concatenated ids of all documents into sequences of ``length``.

    Returns one row per piece: ``doc_id, start`` (ids of its document before it), ``length``,
    ``ids`` (bytes, unsigned 32-bit little endian), ``doc_tokens, sequence_id, offset``. Only
    the last sequence may be shorter. A null or empty text is its end id alone. Rows that
    repeat an id are packed each for itself; a null id stays null. An empty table gives none.
    """
    tokens = materialise(
        tokenize(
            docs, vocabulary, end_id, ranks=ranks, id_column=id_column, text_column=text_column
        ),
        "pack-tokens",
    )
    totals = tokens.groupBy("task").agg(F.sum("tokens").alias("total"))
    # one row per task of the first pass
    before = Window.partitionBy().orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("task").alias("of_task"),
        F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, place, count, ids = batch.columns
            first = place.to_numpy()
            counts = count.to_numpy().astype(np.int64)
            window = first // length
            pieces = (first + counts - 1) // length - window + 1
            row = np.repeat(np.arange(len(first)), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = window[row] + nth
            begin = np.maximum(sequence * length, first[row])
            end = np.minimum((sequence + 1) * length, (first + counts)[row])
            for at in range(0, len(row), 1024):
                part = slice(at, at + 1024)
                own, start = row[part], (begin - first[row])[part]
                size = (end - begin)[part]
                whole_ids = {r: memoryview(ids[r].as_buffer()) for r in set(own.tolist())}
                parts = [
                    bytes(whole_ids[r][4 * s : 4 * (s + n)])
                    for r, s, n in zip(own.tolist(), start.tolist(), size.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        doc.take(pa.array(own)), pa.array(start), pa.array(size),
                        pa.array(parts, pa.binary()), pa.array(counts[own]),
                        pa.array(sequence[part]), pa.array((begin - sequence * length)[part]),
                    ],
                    names=[
                        "doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset",
                    ],
                )

    placed = tokens.join(F.broadcast(offsets), F.col("task") == F.col("of_task")).select(
        "doc_id", (F.col("base") + F.col("start")).alias("place"), "tokens", "ids"
    )
    return placed.mapInArrow(cut, _PIECES)


def with_checksums(pieces: DataFrame) -> DataFrame:
    """Pieces with ``ids_crc32`` in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def public_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
