"""Chat formatting with a grammar round trip.

A turn is rendered as ``<turn>### role: text</turn>`` and a line end. A parser for exactly this
grammar reads the rendering back. Where it does not recover role and text, the content holds
something the grammar uses, and it is rendered again with every control string and backslash
escaped by a backslash. That rendering always comes back; every part written is checked.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.llm.common import named, whole
from storeledger.staging import materialise

# --- Fixed values: the grammar ---
OPEN, HEAD, MIDDLE, CLOSE = "<turn>", "### ", ": ", "</turn>\n"
_TURN = re.compile(
    r"<turn>### ((?:[^\\:<]++|\\.)*+): "
    r"((?:[^\\<#]++|\\.|<(?!/?turn>)|#(?!## ))*+)</turn>\n",
    re.DOTALL,
)
_ROLE_CONTROL = re.compile(r"([\\:<])")
_TEXT_CONTROL = re.compile(r"(\\|<(?=/?turn>)|#(?=## ))")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)

_PART_CHARS = 1 << 20  # a longer conversation goes on in the next part
_SPAN = 1 << 33  # parts of a task
_PARTS = (
    "conv_id {key}, part long, whole boolean, text string,"
    " loss array<struct<start:int,end:int>>, n_turns int"
)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """The turns of a rendered text: role, text, and the span of the (escaped) text.

    Raises ValueError where the text is not of the grammar.
    """
    turns, at = [], 0
    while at < len(text):
        found = _TURN.match(text, at)
        if found is None:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(found[1]), unescape(found[2]), *found.span(2)))
        at = found.end()
    return turns


def render(role: str, text: str) -> str:
    """One turn, escaped only if it does not come back otherwise."""
    plain = f"{OPEN}{HEAD}{role}{MIDDLE}{text}{CLOSE}"
    try:
        if [turn[:2] for turn in parse(plain)] == [(role, text)]:
            return plain
    except ValueError:
        pass
    role, text = _ROLE_CONTROL.sub(r"\\\1", role), _TEXT_CONTROL.sub(r"\\\1", text)
    return f"{OPEN}{HEAD}{role}{MIDDLE}{text}{CLOSE}"


def _part(turns: list[tuple[str, str]], learned: str) -> tuple[str, list[dict]]:
    """Rendered turns and the spans of the texts to learn from."""
    text = "".join(render(*turn) for turn in turns)
    back = parse(text)
    if [turn[:2] for turn in back] != turns:
        raise AssertionError("a rendered conversation does not parse back to its turns")
    return text, [{"start": s, "end": e} for role, _, s, e in back if role == learned]


def format_chats(
    turns: DataFrame,
    *,
    learned_role: str = "assistant",
    conversation_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """Render conversations as text with a loss mask.

    Returns ``conv_id, part, whole, text, loss, n_turns``: ``loss`` lists the character spans of
    the learned role's texts. A conversation is one row, or several parts of about a million
    characters, cut between turns and where a task ends; ``part`` grows along a conversation, and
    ``whole`` marks a part that is known to be all of it. Rows are dealt out by range of
    conversation and turn, so a conversation that holds much of the table is rendered, read back
    and checked by many tasks, and streamed in each.

    Order is the turn number (null first), ties go by role and text. Null roles and texts are
    empty; rows without conversation id are one conversation; repeated rows are repeated turns;
    an empty table gives none.
    """
    rows = turns.select(
        named(conversation_column).alias("conv_id"), named(turn_column).alias("turn"),
        whole(named(role_column)).alias("role"), whole(named(text_column)).alias("text"),
    )
    key = rows.schema["conv_id"].dataType
    order = ["conv_id", "turn", "role", "text"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.select("conv_id", "role", "text", F.spark_partition_id().alias("task"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, task, made, began = None, 0, 0, False
        current, inside, earlier, waiting, size = None, False, 0, [], 0

        def flush(ended: bool) -> pa.RecordBatch:
            text, loss = _part(waiting, learned_role)
            spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([current], kind), pa.array([task * _SPAN + made]),
                    pa.array([ended and inside and not earlier]), pa.array([text]),
                    pa.array([loss], spans), pa.array([len(waiting)], pa.int32()),
                ],
                names=["conv_id", "part", "whole", "text", "loss", "n_turns"],
            )

        for batch in batches:
            kind = batch.column(0).type
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                columns = (c.to_pylist() for c in piece.columns)
                for conv, role, text, own_task in zip(*columns, strict=True):
                    if waiting and (conv != current or size >= _PART_CHARS):
                        yield flush(conv != current)
                        made += 1
                        earlier = earlier + 1 if conv == current else 0
                        waiting, size = [], 0
                    if conv != current or not began:
                        # its first turn is in this task if another one's is before it
                        inside, began = began, True
                    current, task = conv, own_task
                    waiting.append((role, text))
                    size += len(text)
        if waiting:
            yield flush(False)  # may go on in the next task

    return ordered.mapInArrow(run, _PARTS.format(key=key.simpleString()))


def digests(formatted: DataFrame) -> DataFrame:
    """Read formatted conversations back: digests of their turns and of the text to learn from.

    Returns ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, one
    row per conversation; that of the rows without an id has a null id, an empty table gives
    none. Whole parts are read where they are; only the parts of a conversation that lies in
    several tasks are brought together, in order, because a digest needs one stream.
    """
    key = formatted.schema["conv_id"].dataType.simpleString()
    formatted = materialise(formatted, "chat-parts")
    cut = formatted.where("not whole").repartition("conv_id").sortWithinPartitions(
        "conv_id", "part"
    )
    names = [
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, current, state = None, None, None

        def finished() -> pa.RecordBatch:
            turns, learned, counts = state
            row = [current, counts[0], turns.hexdigest(), counts[1], learned.hexdigest(), counts[2]]
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names
            )

        for batch in batches:
            kind = batch.column(0).type
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    if state is not None and row["conv_id"] != current:
                        yield finished()
                        state = None
                    if state is None:
                        state = (hashlib.sha256(), hashlib.sha256(), [0, 0, 0])
                        current = row["conv_id"]
                    turns, learned, counts = state
                    text = row["text"]
                    for role, said, _, _ in parse(text):
                        turns.update(f"{role}\n{said}\n".encode())
                        counts[0] += 1
                    for span in row["loss"]:
                        said = unescape(text[span["start"] : span["end"]])
                        learned.update(said.encode())
                        counts[1] += len(said)
                    counts[2] += len(text)
        if state is not None:
            yield finished()

    schema = (
        f"conv_id {key}, n_turns long, turns_sha256 string, loss_chars long,"
        " loss_sha256 string, formatted_chars long"
    )
    return formatted.where("whole").mapInArrow(run, schema).unionByName(
        cut.mapInArrow(run, schema)
    )
