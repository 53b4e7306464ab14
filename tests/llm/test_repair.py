"""Conversation repair against a search over all edit sequences."""

from __future__ import annotations

import hashlib
import heapq
import os
import random
import re
import zlib
from collections import defaultdict

import pytest

from storeledger.llm import queries, repair

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
KIND = "conv_id long, turn long, role string, text string"
MAY_FOLLOW = {"": "su", "s": "u", "u": "a", "a": "u"}
FULL = {"u": "user", "a": "assistant"}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        code = zlib.crc32(key.encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        row = (conv, turn, "user" if code == 4 else role, text)
        out += [row] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def plain_repair(rows):
    """Cheapest edits first, equal costs by their audits, one edit at a time."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append(
            "blank" if not end else "duplicate" if (role, text) in seen
            else "truncated" if end[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    pairs = zip(rows, rows[1:])
    facts = (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in pairs),
    )
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, state, out = heapq.heappop(heap)
        if at == len(rows) and state in ("", "a"):
            text = "\n".join(f"{r}:{t}" for r, t in out)
            return *facts, cost, audit, hashlib.sha256(text.encode()).hexdigest()
        if (audit, at, state) in done:
            continue
        done.add((audit, at, state))

        def go(price, sign, to, here, turn=()):
            heapq.heappush(heap, (cost + price, audit + sign, to, here, out + turn))

        follow = MAY_FOLLOW[state]
        if at < len(rows):
            _, _, role, text = rows[at]
            go(3, "D", at + 1, state)
            if faults[at] not in ("blank", "duplicate"):
                more = faults[at] == "truncated"
                if role and role[0] in follow:
                    go(more, "K", at + 1, role[0], ((role, text),))
                for k in FULL:
                    if k in follow:
                        go(2 + more, "R", at + 1, k, ((FULL[k], text),))
        for k in FULL:
            if k in follow:
                go(2, "I", at, k, ((FULL[k], ""),))


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    return {conv: plain_repair(own) for conv, own in groups.items()}


def found(spark, rows, **options):
    parts = repair.repaired(spark.createDataFrame(rows, KIND), **options)
    return {r.conv_id: tuple(r)[1:] for r in repair.summary(parts).collect()}


def made_up(seed, conversations=60):
    some = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "u"]
    texts = ["Hi.", "Yes!", "no", "", " \t", "a? ", "x.\n", "Sí…", "y "]
    return [
        (conv, some.choice([t, t, t, t - 1, None]), some.choice(roles), some.choice(texts))
        for conv in [*range(conversations), None] for t in range(some.randint(0, 9))
    ]


@pytest.mark.parametrize("block_rows", [1, 3, 4096])
def test_equals_a_search_over_all_edits(spark, block_rows):
    rows = made_up(3)
    assert found(spark, rows, block_rows=block_rows) == expected(rows)


def test_long_conversation_in_many_tasks(spark):
    """A conversation with most of the rows is cut across tasks and blocks."""
    some = random.Random(5)
    long = [(999, t, some.choice(["user", "assistant"]), f"said {t}" + some.choice(".?! "))
            for t in range(3000)]
    rows = long + made_up(6, 20)
    uncut = found(spark, rows, block_rows=4096)
    assert uncut == found(spark, rows, block_rows=100)
    kinds = [repair.kind_of(r, repair.SOUND if t[-1] in ".?!" else repair.TRUNCATED)
             for _, _, r, t in long]
    assert uncut[999][5] == repair.costs_to_end(kinds, repair.CLOSING)[0][0]
    assert len(uncut[999][6].replace("I", "")) == 3000


def test_audits_spell_the_repair(spark):
    rows = made_up(9)
    for part in repair.repaired(spark.createDataFrame(rows, KIND)).where("whole").collect():
        initials = "".join(r[0] for r in part.roles)
        assert re.fullmatch("(s?(ua)+)?", initials)
        assert len(part.roles) == sum(e != "D" for e in part.audit)
        assert set(part.audit) <= set("DIKR")


def test_nulls_long_texts_repeated_rows_and_clashing_columns(spark):
    long = "word " * 400_000 + "."
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, 0, "user", long),
            (1, 1, "assistant", long), (2, 0, "user", None), (3, 5, "user", "Hi."),
            *[(3, 6, "assistant", "Yes.")] * 500]
    df = spark.createDataFrame(rows, KIND).selectExpr(
        "*", "1 as cost", "'x' as audit", "2 as block", "3 as copies", "4 as fault", "5 as whole"
    )
    got = {r.conv_id: r for r in repair.summary(repair.repaired(df)).collect()}
    assert got[1].audit == "KK" and got[1].cost == 0
    assert got[2].audit == "D" and got[2].blank == 1
    assert got[3].audit == "KK" + "D" * 499 and got[3].duplicate == 499
    assert got[None].audit in ("DKI", "DD") and got[None].gaps == 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], KIND)
    assert repair.repaired(none).collect() == []
    assert repair.report(none, repair.repaired(none)).collect() == []


def test_least_path_among_arcs_with_one_initial():
    """Two arcs with the same initial leave a node: what follows decides."""
    arcs = [(0, 1, 3), (0, 2, 3), (1, 3, 4), (2, 3, 1), (3, 4, 2)]
    assert repair.least_paths(5, arcs, [0, 1]) == (["KDI", "RI"], [4, 4])
    assert repair.least_paths(5, [*arcs, (2, 4, 1)], [0])[0] == ["KD"]


def test_query_equals_the_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    of = expected(plain_damage(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r.conv_id: tuple(r)[1:] for r in queries.registry()["op11_repair"](spark, SF).collect()}
    assert got == {r[0]: of.get(r[0], nothing) for r in rows}


def test_damage(spark):
    rows = made_up(1, 200) + [(1, 1, None, None), (None, None, None, "a.b!c?")]
    damaged = repair.damaged(spark.createDataFrame(rows, KIND))
    assert sorted(map(repr, map(tuple, damaged.collect()))) == sorted(map(repr, plain_damage(rows)))
