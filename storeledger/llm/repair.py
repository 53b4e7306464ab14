"""Conversation structure repair by prefix-doubling path ranking.

A conversation is to read as an optional system turn and pairs of a user and an assistant turn.
Its rows are kept, given another role or deleted, and empty turns are inserted, at the least
cost. The edits form a graph: a node is a row and the role said last, an arc is an edit. The
costs to the end give the optimal arcs. The nodes are then ranked by their least audit (the
initials of the edits) of 1, 2, 4, ... edits, until the ranks are those of whole audits; they
pick the arc of each node, and doubled pointers list the path from the start.

A conversation is worked on in blocks of bounded size. A block costs a 4 x 4 table, from the role
before it to the role behind it; for conversations of several blocks these tables are chained
backwards, and then the blocks are solved one by one, for each role that may come before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.llm.common import named, whole
from storeledger.staging import lookup, materialise

# --- Fixed values: the grammar, the edits and their costs ---
BLANKS = " \t\n\x0b\x0c\r"
LEGAL_PAIRS = ("su", "ua", "au")
SOUND, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
START, SYSTEM, USER, ASSISTANT = range(4)  # what was said last
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT},
        ASSISTANT: {"u": USER}}
FINAL = (START, ASSISTANT)
MADE = {"u": "user", "a": "assistant"}  # roles that an edit can give
REROLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
INITIALS = "DIKR"  # in the order of their characters

_INFINITE = 1 << 50
_BLOCK_ROWS, _BLOCK_CHARS = 4096, 1 << 20
_SPANS = 1 << 33  # blocks of a task


# --- One block: costs, optimal arcs, ranks, paths ---


def _row_arcs(initial: str, fault: int) -> list[list[tuple[int, int, int]]]:
    """For each state the edits of a row: label (place in INITIALS, from 1), cost, state."""
    arcs = []
    for state in range(4):
        own = [(1, DELETE, state)]
        if fault not in (BLANK, DUPLICATE):
            more = CUT_SHORT if fault == TRUNCATED else 0
            if initial in NEXT[state]:
                own.append((3, more, NEXT[state][initial]))
            own += [(4, REROLE + more, to) for role, to in NEXT[state].items() if role in MADE]
        arcs.append(own)
    return arcs


_KINDS = [(i, f) for i in ("s", "u", "a", "") for f in (SOUND, BLANK, TRUNCATED)]
_ARCS = [_row_arcs(i, f) for i, f in _KINDS]
_KIND = {k: at for at, k in enumerate(_KINDS)}
_INSERTS = [[to for role, to in NEXT[s].items() if role in MADE] for s in range(4)]


def kind_of(role: str, fault: int) -> int:
    initial = role[:1] if role[:1] in ("s", "u", "a") else ""
    return _KIND[initial, BLANK if fault == DUPLICATE else fault]


def _with_inserts(costs: Sequence[int]) -> list[int]:
    """Costs from each state when turns may be inserted first."""
    out = list(costs)
    for _ in range(3):  # no cheapest path inserts more than a pair behind a system turn
        out = [min([c, *(INSERT + out[t] for t in _INSERTS[s])]) for s, c in enumerate(out)]
    return out


CLOSING = _with_inserts([0 if s in FINAL else _INFINITE for s in range(4)])


def costs_to_end(kinds: Sequence[int], behind: Sequence[int]) -> list[list[int]]:
    """Least costs from each row and state, given those from the block's end."""
    table = [list(behind)]
    for kind in reversed(kinds):
        after = table[-1]
        table.append(_with_inserts(
            [min(cost + after[to] for _, cost, to in own) for own in _ARCS[kind]]
        ))
    return table[::-1]


def transfer(kinds: Sequence[int]) -> list[int]:
    """Least costs from each state before a block to each state behind it, 4 by 4."""
    columns = []
    for end in range(4):
        behind = [0 if s == end else _INFINITE for s in range(4)]
        columns.append([min(c, _INFINITE) for c in costs_to_end(kinds, behind)[0]])
    return [columns[end][start] for start in range(4) for end in range(4)]


def _optimal_arcs(kinds: Sequence[int], table: list[list[int]], closes: bool):
    """Arcs (from, to, label) that a cheapest path may take; a node is 4 * row + state."""
    arcs = []
    for at, costs in enumerate(table):
        inserts = at < len(kinds) or closes
        for state, cost in enumerate(costs):
            node = 4 * at + state
            if cost >= _INFINITE:
                continue
            if at < len(kinds):
                arcs += [
                    (node, 4 * (at + 1) + to, label)
                    for label, price, to in _ARCS[kinds[at]][state]
                    if price + table[at + 1][to] == cost
                ]
            if inserts:
                arcs += [(node, 4 * at + to, 2) for to in _INSERTS[state]
                         if INSERT + costs[to] == cost]
    return arcs


def least_paths(nodes: int, arcs, starts: Sequence[int]) -> tuple[list[str], list[int]]:
    """The least audit from each start, and the node where it ends.

    ``arcs`` are those of a graph without cycles in which any arc may be taken. ``ends`` holds
    for each node the ends of its least audits of a length: to double the length, the ends with
    the lowest rank go on, and ranks of pairs (first half, second half) become the new ranks.
    """
    source, target, label = np.array(arcs, dtype=np.int64).reshape(-1, 3).T
    last = np.ones(nodes, bool)
    last[source] = False
    stay = np.flatnonzero(last)
    source, target = np.concatenate([source, stay]), np.concatenate([target, stay])
    label = np.concatenate([label, np.zeros(len(stay), np.int64)])  # an ended audit is less
    initial = np.full(nodes, len(INITIALS) + 1)
    np.minimum.at(initial, source, label)

    rank = initial
    least = label == initial[source]
    ends = source[least], target[least]
    while not last[ends[1]].all():
        second = np.full(nodes, np.iinfo(np.int64).max)
        np.minimum.at(second, ends[0], rank[ends[1]])
        least = rank[ends[1]] == second[ends[0]]
        own, middle = ends[0][least], ends[1][least]
        order = np.argsort(ends[0], kind="stable")
        onward = ends[1][order]
        first = np.searchsorted(ends[0][order], np.arange(nodes + 1))
        count = first[middle + 1] - first[middle]
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        reached = onward[np.repeat(first[middle], count) + step]
        rank = np.unique(rank * (nodes + 5) + second, return_inverse=True)[1]
        pairs = np.unique(np.repeat(own, count) * nodes + reached)
        ends = pairs // nodes, pairs % nodes

    order = np.lexsort((rank[target], label, source))
    pick = order[np.searchsorted(source[order], np.arange(nodes))]
    jumps = [target[pick]]
    while not last[jumps[-1][starts]].all():
        jumps.append(jumps[-1][jumps[-1]])
    paths = np.array(starts, dtype=np.int64)[:, None]
    for jump in reversed(jumps):
        paths = np.stack([paths, jump[paths]], axis=2).reshape(len(starts), -1)
    signs = np.frombuffer(b" " + INITIALS.encode(), "S1")[initial[paths]]
    audits = [b"".join(row).decode().rstrip(" ") for row in signs]
    return audits, jumps[-1][starts].tolist()


def solve(blocks: list[tuple[list[int], list[int], bool, Sequence[int]]]):
    """For each block (kinds, costs behind it, whether it closes the conversation, states to
    start from) one (cost, audit, state behind) per start; the blocks are ranked together."""
    arcs, starts, tables, base = [], [], [], 0
    for kinds, behind, closes, states in blocks:
        table = costs_to_end(kinds, behind)
        arcs += [(base + a, base + b, c) for a, b, c in _optimal_arcs(kinds, table, closes)]
        starts += [base + s for s in states]
        tables.append((table, states))
        base += 4 * len(table)
    audits, ends = least_paths(base, arcs, starts)
    found = iter(zip(audits, ends, strict=True))
    return [
        [(table[0][s], audit, end % 4) for s, (audit, end) in zip(states, found)]
        for table, states in tables
    ]


def edited(
    audit: str, state: int, roles: Sequence[str], texts: Sequence[str]
) -> tuple[list[str], list[str]]:
    """The turns that an audit makes of rows, after what ``state`` says was said last."""
    rows, out_roles, out_texts = iter(zip(roles, texts, strict=True)), [], []
    for edit in audit:
        role, text = (None, "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K":
            state = NEXT[state][role[:1]]
        else:
            initial, state = next(x for x in NEXT[state].items() if x[0] in MADE)
            role = MADE[initial]
        out_roles.append(role)
        out_texts.append(text)
    return out_roles, out_texts


# --- Rows with faults ---


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults in them, set by the CRC-32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it the
    user's. Nulls count as one space, in role and text and in what the CRC is taken of.
    """
    def space(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = (
        F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    return (
        turns.select(
            "conv_id", "turn", space("role").alias("role"), space("text").alias("text"),
            code.alias("code"),
        )
        .where("code <> 0")
        .select(
            "conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
            .alias("role"), text.alias("text"),
            F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1)))
                      .otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """Equal rows once, with ``copies`` and the first fault of the first of them."""
    said = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    conv = F.col("conv_id").cast("string")
    known = F.concat_ws("\n", F.length(conv), conv, F.length("role"), "role", "text")
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"))  # nulls first
    said = materialise(said.withColumn("said", F.sha2(known, 256)), "said")
    first = (
        said.groupBy("said").agg(F.min(place).alias("first"), F.count("*").alias("times"))
        .where("times > 1").drop("times")
    )
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (
        F.when(end == "", BLANK)
        .when(F.coalesce(place > F.col("first"), F.lit(False)), DUPLICATE)
        .when(~F.right(end, F.lit(1)).isin(".", "!", "?"), TRUNCATED)
        .otherwise(SOUND)
    )
    return lookup(said, first, "said").select(
        "conv_id", "turn", "role", "text", "copies", fault.alias("fault")
    )


# --- Blocks ---

_BLOCK = (
    "conv_id {key}, block long, whole boolean, roles array<string>, texts array<string>,"
    " faults array<int>, turns array<long>"
)
_PART = (
    "conv_id {key}, block long, whole boolean, cost long, audit string, roles array<string>,"
    " texts array<string>, blank long, duplicate long, truncated long, illegal long,"
    " first_initial string, last_initial string, first_turn long, last_turn long,"
    " distinct_turns long"
)


def _list(values: list, kind: pa.DataType) -> pa.Array:
    return pa.array(values, pa.list_(kind))


def blocks(rows: DataFrame, most_rows: int = _BLOCK_ROWS) -> DataFrame:
    """Conversations in blocks, in the order of turn (nulls first), role and text.

    A block has at most ``most_rows`` rows and ends with the row that makes it a million
    characters. Rows are dealt out by range, so a long conversation lies in several tasks. ``whole`` marks
    a block that is known to be a conversation; ``block`` grows along a conversation.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "turn", "role", "text"]
    dealt = materialise(rows, "faults").repartitionByRange(*order).sortWithinPartitions(*order)
    with_task = dealt.select(*order, "copies", "fault", F.spark_partition_id().alias("task"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, task, made, fresh = None, 0, 0, True
        current, size, count, opened = None, 0, 0, False
        held: tuple[list, ...] = ([], [], [], [])

        def close(more: bool, known: bool) -> pa.RecordBatch:
            nonlocal held, size, made, count
            is_whole = known and count == 0 and not more
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([current], key), pa.array([task * _SPANS + made]),
                    pa.array([is_whole]), _list([held[0]], pa.string()),
                    _list([held[1]], pa.string()), _list([held[2]], pa.int32()),
                    _list([held[3]], pa.int64()),
                ],
                names=["conv_id", "block", "whole", "roles", "texts", "faults", "turns"],
            )
            held, size, made, count = ([], [], [], []), 0, made + 1, count + 1
            return out

        for batch in batches:
            key = batch.column(0).type
            for start in range(0, batch.num_rows, 256):
                columns = [c.to_pylist() for c in batch.slice(start, 256).columns]
                for conv, turn, role, text, copies, fault, task in zip(*columns, strict=True):
                    if conv != current or fresh:
                        if held[0]:
                            yield close(False, opened)
                        opened, current, count, fresh = not fresh, conv, 0, False
                    for nth in range(copies):
                        if held[0] and (len(held[0]) >= most_rows or size >= _BLOCK_CHARS):
                            yield close(True, opened)
                        own = DUPLICATE if nth and fault != BLANK else fault
                        for values, value in zip(held, (role, text, own, turn), strict=True):
                            values.append(value)
                        size += len(role) + len(text)
        if held[0]:
            yield close(False, False)  # may go on in the next task

    return materialise(with_task.mapInArrow(run, _BLOCK.format(key=kind)), "blocks")


@dataclass
class _Facts:
    """What a block says about its conversation, besides the edits."""

    roles: list[str]
    faults: list[int]
    turns: list[int | None]

    def columns(self) -> tuple:
        initials = [r[:1] for r in self.roles]
        turns = [t for t in self.turns if t is not None]
        pairs = zip(initials, initials[1:])
        return (
            *(self.faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)),
            sum(a + b not in LEGAL_PAIRS for a, b in pairs), initials[0], initials[-1],
            turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)),
        )


def _chained(tables: DataFrame) -> DataFrame:
    """Costs behind every block of conversations in several blocks, last block first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, behind, fresh = None, None, True
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                rows, closing = [], []
                piece = batch.slice(start, 1024)
                for conv, table in zip(
                    piece.column(0).to_pylist(), piece.column(2).to_pylist(), strict=True
                ):
                    closing.append(fresh or conv != current)
                    if closing[-1]:
                        current, behind, fresh = conv, CLOSING, False
                    rows.append(behind)
                    behind = [
                        min(min(table[4 * s + e] + behind[e] for e in range(4)), _INFINITE)
                        for s in range(4)
                    ]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(1), _list(rows, pa.int64()), pa.array(closing)],
                    names=["block", "behind", "closes"],
                )

    ordered = tables.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))
    return ordered.mapInArrow(run, "block long, behind array<long>, closes boolean")


def repaired(turns: DataFrame, *, block_rows: int = _BLOCK_ROWS) -> DataFrame:
    """Conversations made to read ``(s?(ua)+)?`` by role initials, at the least cost.

    Takes ``conv_id, turn, role, text``. Keeping a row costs 0, giving it the role user or
    assistant 2, deleting it 3, inserting an empty turn of these 2. Rows that are blank, or repeat
    role and text of an earlier row of their conversation, must be deleted; rows kept without
    ``.``, ``!`` or ``?`` at their end cost 1 more. Of edits at the same cost those with the
    least audit, their initials in order, are taken.

    Returns parts of conversations, ordered by ``block``: ``conv_id, block, whole, cost`` (of
    this part), ``audit, roles, texts`` (the repaired turns) and counts of the faults found.
    ``whole`` marks a part that is known to be all of its conversation. Rows are in the order of
    turn (null first), role and text. Null roles and texts are empty; rows without conversation
    id are one conversation; repeated rows are duplicates; extra columns are ignored; an empty
    table gives none. A part has at most ``block_rows`` rows, so no conversation is held in
    memory.
    """
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        whole(named("role")).alias("role"), whole(named("text")).alias("text"),
    )
    kind = rows.schema["conv_id"].dataType.simpleString()
    cut = blocks(with_faults(rows), block_rows)
    part = _PART.format(key=kind)
    names = [c.split()[0] for c in part.split(", ")]
    types = [pa.int64()] * 2 + [pa.string()] * 2

    def finished(batch: pa.RecordBatch, first, answers) -> pa.RecordBatch:
        roles, texts, faults, turns = (batch.column(c).to_pylist()
                                       for c in ("roles", "texts", "faults", "turns"))
        facts = [_Facts(*x).columns() for x in zip(roles, faults, turns, strict=True)]
        made = [edited(a[1], s, r, t)
                for a, s, r, t in zip(answers, first, roles, texts, strict=True)]
        by_fact = list(zip(*facts, strict=True))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"), batch.column("block"), batch.column("whole"),
                pa.array([a[0] for a in answers], pa.int64()), pa.array([a[1] for a in answers]),
                _list([r for r, _ in made], pa.string()),
                _list([t for _, t in made], pa.string()),
                *[pa.array(c, pa.string() if 4 <= i < 6 else pa.int64())
                  for i, c in enumerate(by_fact)],
            ],
            names=names,
        )

    def pieces(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[list[int]]]]:
        """Rows of a batch with their kinds, a few at a time: a long block comes alone."""
        at = 0
        while at < batch.num_rows:
            kinds = []
            for here in range(at, min(at + 256, batch.num_rows)):
                row = batch.slice(here, 1)
                own = [kind_of(r, f) for r, f in zip(
                    row.column("roles")[0].as_py(), row.column("faults")[0].as_py(), strict=True
                )]
                if kinds and max(len(own), *map(len, kinds)) > 64:
                    break
                kinds.append(own)
            yield batch.slice(at, len(kinds)), kinds
            at += len(kinds)

    def at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, kinds in pieces(batch):
                answers = solve([(k, CLOSING, True, (START,)) for k in kinds])
                yield finished(piece, [START] * len(kinds), [a[0] for a in answers])

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, kinds in pieces(batch):
                yield pa.RecordBatch.from_arrays(
                    [piece.column("conv_id"), piece.column("block"),
                     _list([transfer(k) for k in kinds], pa.int64())],
                    names=["conv_id", "block", "table"],
                )

    options_kind = pa.list_(pa.struct(
        [("cost", types[0]), ("audit", types[2]), ("state", types[1])]
    ))

    def options(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, kinds in pieces(batch):
                answers = solve([
                    (k, b, c, range(4)) for k, b, c in zip(
                        kinds, piece.column("behind").to_pylist(),
                        piece.column("closes").to_pylist(), strict=True,
                    )
                ])
                structs = [[dict(zip(("cost", "audit", "state"), x, strict=True)) for x in a]
                           for a in answers]
                kept = piece.drop_columns(["behind", "closes"])
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(structs, options_kind)],
                    names=[*kept.schema.names, "options"],
                )

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Along a conversation: the state behind a block picks the next one's edits."""
        current, state, fresh = None, START, True
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                conv, ways = row.column("conv_id")[0].as_py(), row.column("options")[0].as_py()
                if fresh or conv != current:
                    current, state, fresh = conv, START, False
                way = ways[state]
                left = ways[state]["cost"]
                yield finished(row, [state], [(left, way["audit"])])
                state = way["state"]

    closed = cut.where("whole").mapInArrow(at_once, part)
    long = cut.where("not whole")
    behind = _chained(
        long.mapInArrow(tables, f"conv_id {kind}, block long, table array<long>")
    )
    kept = "conv_id block whole roles texts faults turns".split()
    solved = lookup(long, behind, "block", "inner").select(*kept, "behind", "closes").mapInArrow(
        options,
        _BLOCK.format(key=kind) + ", options array<struct<cost:long,audit:string,state:long>>",
    )
    opened = solved.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return closed.unionByName(opened.mapInArrow(chosen, part))


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def summary(parts: DataFrame) -> DataFrame:
    """One row per repaired conversation: its faults, cost, audit and the digest of
    ``role:text`` of its turns, joined by line ends. ``cost`` of a part is what is left to pay
    from there on, so a conversation's is its first part's."""
    kind = parts.schema["conv_id"].dataType.simpleString()
    lines = F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t))
    gaps = F.coalesce(
        F.col("last_turn") - F.col("first_turn") + 1 - F.col("distinct_turns"), F.lit(0)
    )
    digest = F.sha2(F.array_join(lines, "\n"), 256)
    columns = [
        "conv_id", gaps.cast("long").alias("gaps"), *_COUNTS[1:], "audit",
        digest.alias("repaired_sha256"),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Streams the parts of conversations that lie in several."""
        state, current, key = None, None, None

        def done() -> pa.RecordBatch:
            first, last, distinct = state["first"], state["last"], state["distinct"]
            counts = [0 if first is None else last - first + 1 - distinct,
                      *(state[c] for c in _COUNTS[1:])]
            values = [current, *counts, "".join(state["audit"]), state["hash"].hexdigest()]
            kinds = [key, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, kinds, strict=True)],
                names=["conv_id", *_COUNTS, "audit", "repaired_sha256"],
            )

        for batch in batches:
            key = batch.schema.field("conv_id").type
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if state is not None and row["conv_id"] != current:
                    yield done()
                    state = None
                if state is None:
                    current = row["conv_id"]
                    state = {"hash": hashlib.sha256(), "audit": [], "said": False, "end": None,
                             "first": None, "last": None, "distinct": 0, "cost": row["cost"],
                             "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
                state["audit"].append(row["audit"])
                for name in ("blank", "duplicate", "truncated", "illegal"):
                    state[name] += row[name]
                if state["end"] is not None:
                    pair = state["end"] + row["first_initial"]
                    state["illegal"] += pair not in LEGAL_PAIRS
                state["end"] = row["last_initial"]
                if row["first_turn"] is not None:
                    state["distinct"] += row["distinct_turns"] - (
                        row["first_turn"] == state["last"]
                    )
                    if state["first"] is None:
                        state["first"] = row["first_turn"]
                    state["last"] = row["last_turn"]
                for role, text in zip(row["roles"], row["texts"], strict=True):
                    line = f"{role}:{text}"
                    state["hash"].update(("\n" + line if state["said"] else line).encode())
                    state["said"] = True
        if state is not None:
            yield done()

    schema = (
        f"conv_id {kind}, " + ", ".join(f"{c} long" for c in _COUNTS)
        + ", audit string, repaired_sha256 string"
    )
    opened = parts.where("not whole").repartition("conv_id")
    return parts.where("whole").select(*columns).unionByName(
        opened.sortWithinPartitions("conv_id", "block").mapInArrow(run, schema)
    )


def report(turns: DataFrame, repaired_parts: DataFrame) -> DataFrame:
    """``summary`` for every conversation of ``turns``; those without rows left to repair have
    zeros, an empty audit and the digest of nothing."""
    every = turns.select("conv_id").distinct().withColumnRenamed("conv_id", "of")
    found = summary(repaired_parts)
    empty = {**dict.fromkeys(_COUNTS, 0), "audit": "", "repaired_sha256":
             hashlib.sha256(b"").hexdigest()}
    return every.join(found, F.col("of").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("of").alias("conv_id"),
        *[F.coalesce(F.col(c), F.lit(v).cast(found.schema[c].dataType)).alias(c)
          for c, v in empty.items()],
    )
