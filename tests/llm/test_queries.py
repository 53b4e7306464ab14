"""The registered queries over whole given tables."""

from __future__ import annotations

import hashlib
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from storeledger.llm import queries
from tests.llm.test_small import VOCABULARY, plain_components, targets
from tests.oracle import connect, differences

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def rows(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def result(spark, name):
    return queries.registry()[name](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    sql = queries.oracle_sql()[name]
    assert differences(entry.queries()[name](spark, SF), connect(SF), sql) == []


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def test_mix(spark, rows):
    got = {r.doc_id: r for r in result(spark, "op2_mix")}
    sizes, taken = Counter(), Counter()
    for r in rows:
        size = len((r.text or "").split())  # no other blanks in these texts
        assert got[r.doc_id]["size"] == size
        assert got[r.doc_id].taken <= 2 * size
        sizes[r.source] += size
        taken[r.source] += got[r.doc_id].taken
    for source, target in targets(sizes).items():
        longest = max(len((r.text or "").split()) for r in rows if r.source == source)
        assert abs(taken[source] - target) <= longest


def test_near_join(spark, rows):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in result(spark, "op4_near_join"))
    assert got == plain_components([(r.doc_id, r.text) for r in rows], 4, 85)


def test_fingerprints(spark, rows):
    order = sorted(rows, key=lambda r: -r.doc_id)
    got = {r.doc_id: r for r in result(spark, "op6_fingerprints")}
    errors = []
    for row, after in zip(order, order[1:] + order[:1], strict=True):
        text, third = row.text or "", len(row.text or "") // 3
        edited = text[: len(text) - third] + (after.text or "")[:third]
        found = got[row.doc_id]
        assert found.n_chars == len(text)
        assert found.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        sets = []
        for t in (text, edited, after.text or ""):
            words = t.lower().split()
            sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
        for value, other in ((found.near_edited, sets[1]), (found.near_next, sets[2])):
            assert 0 <= value <= 1
            if len(sets[0] | other) > 200:
                errors.append(abs(value - len(sets[0] & other) / len(sets[0] | other)))
    assert len(errors) > 50 and np.mean(errors) < 0.05
    for a in rows:
        for b in rows:
            if a.text == b.text:
                assert got[a.doc_id].fingerprint == got[b.doc_id].fingerprint


def test_shards(spark, rows):
    got = {r.doc_id: r for r in result(spark, "op7_shard")}
    slots, shards = defaultdict(list), defaultdict(set)
    loads, groups = Counter(), Counter()
    for r in rows:
        loads[got[r.doc_id].shard] += got[r.doc_id]["size"]
        groups[r.text] += got[r.doc_id]["size"]
    # no shard is further above an even share than the largest group of equal texts
    assert max(loads.values()) <= sum(loads.values()) / 40 + max(groups.values())
    assert set(loads) <= set(range(40))
    for r in rows:
        found, data = got[r.doc_id], (r.text or "").encode()
        assert found["size"] == len(data) + 16 and found.text_crc32 == zlib.crc32(data)
        slots[found.shard].append(found.slot)
        shards[r.text].add(found.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shards.values())


def test_held_out_languages(spark, rows):
    got = {r.doc_id: r for r in result(spark, "op8_language_id")}
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert {r.doc_id for r in got.values() if r.held_out} == {r.doc_id for r in held}
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in held]) >= 0.95


def tokens(text):
    from tokenizers import Tokenizer

    if not hasattr(tokens, "of"):
        tokens.of = Tokenizer.from_file(VOCABULARY)
    return tokens.of.encode(text or "", add_special_tokens=False).ids + [1]


def test_pack(spark, rows):
    pieces = defaultdict(dict)
    ends = Counter()
    for r in result(spark, "op9_pack"):
        pieces[r.doc_id][r.start] = r
        ends[r.sequence_id] += r.length
    assert all(n == 2048 for s, n in ends.items() if s != max(ends)) and min(ends) == 0
    for r in rows:
        ids, at = tokens(r.text), 0
        while at < len(ids):
            piece = pieces[r.doc_id].pop(at)
            part = np.array(ids[at : at + piece.length], "<u4").tobytes()
            assert piece.ids_crc32 == zlib.crc32(part) and piece.doc_tokens == len(ids)
            at += piece.length
        assert not pieces[r.doc_id]


def test_pipeline_as_plain_python(spark, rows):
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns
        kept.append(docs.collect())
    known, single, apart, mixed = kept
    # all of these texts are clean: only those without a letter go
    assert {r.doc_id for r in known} == {
        r.doc_id for r in rows if any(c.isalpha() for c in r.text or "")
    }
    newest = {}
    for r in known:
        newest[r.text] = max(r.doc_id, newest.get(r.text, r.doc_id))
    assert {r.doc_id for r in single} == set(newest.values())
    components = plain_components([(r.doc_id, r.text) for r in single], 5, 80)
    assert {r.doc_id for r in apart} == {root for _, _, root in components}
    sizes, taken = Counter(), Counter()
    for r in apart:
        sizes[r.source] += len(r.text.split())
    for r in mixed:
        taken[r.source] += len(r.text.split())
    for source, target in targets(sizes).items():
        longest = max(len(r.text.split()) for r in apart if r.source == source)
        assert abs(taken[source] - target) <= longest
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    stream = b"".join(p.ids for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)))
    found, current = Counter(), []
    for token in np.frombuffer(stream, "<u4").tolist():
        current.append(token)
        if token == 1:  # no text of these holds this id
            found[tuple(current)] += 1
            current = []
    assert found == Counter(tuple(tokens(r.text)) for r in mixed)


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "ids", "sequence_id", "offset"} <= set(got.columns)
    assert got.count() > 0
