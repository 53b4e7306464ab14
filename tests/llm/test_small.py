"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from storeledger.llm import (
    chat, exact_dedup, fingerprints, language_id, licenses, line_dedup, mixing, near_join,
    packing, sharding,
)
from tests.llm.conftest import EDGE, LONG, SAID

VOCABULARY = packing.public_vocabulary()
RANKS = packing.public_vocabulary("byte_bpe_50k.tiktoken")


def small_pack(df):
    return packing.pack(df, VOCABULARY, ranks=RANKS, length=64)


def predicted(df):
    return language_id.predict(df, language_id.LanguageModel([], None))


@pytest.mark.parametrize("operator", [
    mixing.mix, mixing.take, licenses.scan, near_join.near_components, near_join.keep_one,
    line_dedup.drop_lines, fingerprints.edited_pairs, sharding.shard, predicted, small_pack,
    exact_dedup.exact_groups, exact_dedup.drop_copies,
])
def test_empty_table(docs, operator):
    assert operator(docs([], clashing=True)).collect() == []


# --- exact dedup ---


def test_exact_groups(docs):
    rows = exact_dedup.exact_groups(docs(EDGE, clashing=True)).collect()
    texts = defaultdict(list)
    for doc, text in EDGE:
        texts[text or ""].append(doc)
    assert len(rows) == len({(d, t or "") for d, t in EDGE})
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in texts.items()}
    for r in rows:
        ids = by_hash[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids)
        assert r.keep_id == max(known, default=None)
        assert r.kept == (r.doc_id == r.keep_id)


def test_drop_copies(docs):
    df = docs(EDGE, clashing=True)
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    assert Counter(r.text or "" for r in rows) == Counter({t or "" for _, t in EDGE})
    assert {r.doc_id for r in rows if r.text == SAID} == {8}


def test_chunks_are_the_text(docs):
    for row in docs([(1, LONG), (2, "🙂" * 9000), (3, "x" * 5000)]).select(
        "text", exact_dedup.chunks(F.col("text")).alias("chunks")
    ).collect():
        assert "".join(row.chunks) == row.text
        assert all(512 <= len(c) <= 4096 for c in row.chunks[:-1])


def test_colliding_chunk_identifiers_are_told_apart(docs, monkeypatch):
    """With identifiers of one value under the first seed, the next seed is taken."""
    real = exact_dedup._identifier
    constant = F.struct(F.lit(1).cast("long").alias("a"), F.lit(1).cast("long").alias("b"))
    monkeypatch.setattr(
        exact_dedup, "_identifier", lambda c, seed: constant if seed == 0 else real(c, seed)
    )
    rows = exact_dedup.exact_groups(docs([(1, "x"), (2, "y"), (3, "x")])).collect()
    assert {r.doc_id: r.keep_id for r in rows} == {1: 3, 2: 2, 3: 3}


# --- line dedup ---


def plain_lines(rows, min_docs=3):
    strip, table = " \t\n\x0b\x0c\r", str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                                     "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(strip).translate(table)
    held = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            held[key(line)].add(doc)
    cut = {k: max(ids, key=lambda i: (i is not None, i or 0))
           for k, ids in held.items() if len(k) >= 20 and len(ids) >= min_docs}
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in cut or cut[key(x)] == doc]
        yield doc, "\n".join(kept), len(lines), len(lines) - len(kept)


LINES = [
    (i, "\n".join(["  A line that is found in many DOCUMENTS\t", f"own line {i}", "short",
                   *(["twice in here, and in every other one"] * 2)])) for i in range(40)
] + [(99, "\n".join(f"only {i % 80} is repeated within this text" for i in range(300))),
     (None, "a line that is found in many documents"), (3, None), (4, ""),
     (5, "a line that is found in many documents\nbeside another text of this id")]


@pytest.mark.parametrize("hot_share", [2, 1000, 10**9])
def test_line_dedup_as_plain_search(docs, monkeypatch, hot_share):
    monkeypatch.setattr(line_dedup, "_HOT_SHARE", hot_share)
    df = docs(LINES, clashing=True)
    got = line_dedup.drop_lines(df).collect()
    assert Counter((r.doc_id, r.text or "", r.n_lines_, r.n_dropped) for r in got) == Counter(
        plain_lines(LINES)
    )


def test_line_dedup_edge_rows(docs):
    got = line_dedup.drop_lines(docs(EDGE)).collect()
    assert Counter((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in got) == Counter(
        plain_lines(EDGE)
    )


# --- mixing ---


def targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2.0) -> dict:
    """Share by weight, give what is above a limit to the others, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), share * sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in sizes if s not in full)
        over = {s for s in sizes if s not in full
                and rest * weight[s] / open_weight > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else rest * weight[s] / open_weight
                    for s in sizes}
        full |= over


def test_mix_reaches_its_targets(docs):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "en", f"s{(i * i) % 5}") for i in range(3000)]
    rows += [(10_000 + i, "a b", "en", None) for i in range(50)] + [(20_000, None, "en", "s0")]
    rows += [(20_001, "tiny source", "en", "a"), (20_002, "", "en", "empty"), (None, "x", "en", "s1")]
    df = docs(rows)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert r.taken == r.size * r.copies and r.copies in (0, 1, 2)
    expected = targets(sizes)
    for r in got:
        assert r.target == pytest.approx(expected[r.source]) and r.source_size == sizes[r.source]
    for source in sizes:
        assert abs(taken[source] - expected[source]) <= 7
    again = mixing.mix(df.repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_larger_budgets_take_supersets(docs):
    df = docs([(i, f"word {i}") for i in range(500)])
    few = {r.doc_id: r.copies for r in mixing.mix(df, share=0.4).collect()}
    more = {r.doc_id: r.copies for r in mixing.mix(df, share=0.7).collect()}
    assert all(more[d] >= few[d] for d in few) and sum(more.values()) > sum(few.values())


def test_take_repeats_rows(docs):
    df = docs(EDGE, clashing=True)
    decided = Counter()
    for r in mixing.mix(df).collect():
        decided[r.doc_id] += r.copies if r.size else 1
    got = mixing.take(df)
    assert got.columns == df.columns
    assert Counter(r.doc_id for r in got.collect()) == +decided


# --- near join ---


def plain_components(rows, width, percent):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def shingles(text):
        words = (text or "").translate(table).replace("\x0b", " ").replace("\x0c", " ")
        words = [w for w in words.replace("\r", " ").replace("\n", " ").replace("\t", " ")
                 .split(" ") if w]
        if len(words) < width:
            return frozenset([tuple(words)] if words else [])
        return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))

    sets = [(doc, shingles(text)) for doc, text in rows]
    root = {doc: doc for doc, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, set_a) in enumerate(sets):
        for b, set_b in sets[:i]:
            if set_a and set_b and 100 * len(set_a & set_b) >= percent * len(set_a | set_b):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return Counter((doc, len(s), find(doc)) for doc, s in sets)


def near_texts():
    """Groups whose members differ from a common text by one to a tenth of their words."""
    rng = np.random.default_rng(5)
    word = lambda: f"w{rng.integers(4000)}"
    passage = [word() for _ in range(60)]
    rows = []
    for group in range(12):
        base = [word() for _ in range(int(rng.integers(4, 260)))] + passage * (group % 2)
        for _ in range(int(rng.integers(1, 40))):
            text = list(base)
            for _ in range(int(rng.integers(0, max(1, len(text) // 25) + 1))):
                text[int(rng.integers(len(text)))] = word()
            rows.append((len(rows) * 7 % 1009, " ".join(text)))
    return rows


@pytest.mark.parametrize(("width", "percent", "short"), [(5, 80, 32), (4, 85, 32), (5, 80, 2)])
def test_near_components_as_brute_force(docs, monkeypatch, width, percent, short):
    monkeypatch.setattr(near_join, "_SHORT_LIST", short)
    rows = near_texts() + [r for r in [(2001 + i, t) for i, (d, t) in enumerate(EDGE) if d]]
    got = near_join.near_components(docs(rows, clashing=True), width=width, percent=percent)
    assert Counter(map(tuple, got.collect())) == plain_components(rows, width, percent)


def test_near_components_edge_rows(docs):
    got = near_join.near_components(docs(EDGE)).collect()
    assert len(got) == len(EDGE)
    found = defaultdict(set)
    for r in got:
        found[r.doc_id].add((r.n_shingles, r.component_id))
    assert found[1] == {(0, 1)} and found[5] == {(1, 4)} and found[12] == found[11]
    assert found[9] == {(15, 7)} and found[None] == {(14, 7), (0, None)}


def test_keep_one(docs):
    df = docs([(3, SAID), (1, SAID + " more"), (2, "other words are in this text"), (None, SAID)])
    kept = near_join.keep_one(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, None}


def test_long_chain_of_links_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    roots = {r.doc: r.root for r in near_join.components(links).collect()}
    assert roots == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


# --- licenses ---


def test_licenses(docs):
    mit = licenses.TEMPLATES["mit-permission"]
    near = mit.replace("sublicense", "sub-license")
    rows = [(1, f"{SAID}\n{mit} {SAID}"), (2, f"x {near} y"), (3, "released under the MIT license"),
            (4, "Released under the GPL License."), (5, None), (None, "Released under the MIT License.")]
    got = {(r.doc_id, r.license): r for r in licenses.scan(docs(rows, clashing=True)).collect()}
    assert set(got) == {(1, "mit-permission"), (2, "mit-permission"), (3, "mit-notice"),
                        (None, "mit-notice")}
    assert got[1, "mit-permission"].containment == 1.0
    assert 0.8 <= got[2, "mit-permission"].containment < 1.0


def test_template_must_have_a_shingle():
    with pytest.raises(ValueError):
        licenses.template("short", "All rights reserved")


def test_short_templates(docs):
    rows = [(1, "Copyright 2020 N. N. All Rights\nReserved. " + SAID), (2, "all rights reserved"),
            (3, "All rights are reserved, all rights"), (4, "rights reserved"), (5, None),
            (None, "x all rights reserved, all rights reserved")]
    kinds = "doc_id", "license", "containment", "n_windows", "first_word"
    got = licenses.scan(docs(rows)).select(*kinds).collect()
    name = "all-rights-reserved"
    assert Counter(map(tuple, got)) == Counter(
        [(1, name, 1.0, 1, 4), (2, name, 1.0, 1, 0), (None, name, 1.0, 2, 1)]
    )
    only = licenses.scan(docs(rows), {"two": "rights reserved", "one": "quick"})
    assert {(r.doc_id, r.license) for r in only.collect()} == {
        (1, "two"), (1, "one"), (2, "two"), (4, "two"), (None, "two")
    }


def test_public_headers(docs):
    gnu = ("This program is free software; you can redistribute it and/or modify it under the terms"
           " of the GNU {}General Public License as published by the Free Software Foundation;"
           " either version {} of the License, or (at your option) any later version.")
    by = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    planted = {
        gnu.format("", 2): {"gpl-header", "gnu-version-2-or-later"},
        gnu.format("", 3): {"gpl-header", "gnu-version-3-or-later"},
        gnu.format("Lesser ", 2.1): {"lgpl-header", "gnu-version-2.1-or-later"},
        gnu.format("Affero ", 3): {"agpl-header", "gnu-version-3-or-later"},
        by.format(""): {"cc-by-4.0-statement"},
        by.format("-NonCommercial"): {"cc-by-nc-4.0-statement"},
        by.format("-ShareAlike"): {"cc-by-sa-4.0-statement"},
        by.format("-NonCommercial-NoDerivatives"): set(),
    } | {text: {name} for name, text in licenses.MORE_TEMPLATES.items()}
    rows = [(i, f"{SAID}\n// {text}\n{SAID}") for i, text in enumerate(planted)]
    got = defaultdict(set)
    for r in licenses.scan(docs(rows)).collect():
        got[r.doc_id].add(r.license)
    assert [got[i] for i, _ in rows] == list(planted.values())


# --- fingerprints ---


def test_edited_texts(docs):
    got = fingerprints.edited_pairs(docs(EDGE, clashing=True)).collect()
    rows = sorted(((d, t or "") for d, t in EDGE), key=lambda r: -(r[0] or -1))
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    texts = defaultdict(set)
    for d, t in rows:
        texts[d].add(t)
    ids = list(dict.fromkeys(d for d, _ in rows))
    for r in got:
        if len(texts[r.doc_id]) == 1 and r.doc_id is not None and r.doc_id != 8:
            after = ids[(ids.index(r.doc_id) + 1) % len(ids)]
            third = len(r.text) // 3
            expected = {r.text[: len(r.text) - third] + t[:third] for t in texts[after]}
            assert r.edited in expected and r.n_chars == len(r.text)


def test_sketches(spark, docs):
    words = [f"w{i}" for i in range(4000)]
    df = spark.createDataFrame(
        [(" ".join(words), " ".join(words[:400]), " ".join(words[2000:] + words[:1000]))],
        "whole string, part string, other string",
    ).select(*[fingerprints.sketch(F.col(c)).alias(c) for c in ("whole", "part", "other")])
    row = df.select(
        fingerprints.containment(F.col("part"), F.col("whole")).alias("inside"),
        fingerprints.containment(F.col("whole"), F.col("part")).alias("around"),
        fingerprints.likeness(F.col("whole"), F.col("other")).alias("alike"),
        F.size("whole").alias("size"),
        (fingerprints.merged(F.col("whole"), F.col("part")) == F.col("whole")).alias("merges"),
    ).first()
    assert row.inside == 1.0 and row.around == pytest.approx(0.1, abs=0.04)
    assert row.alike == pytest.approx(0.75, abs=0.08)
    assert row["size"] == pytest.approx(500, rel=0.15) and row.merges


def test_sketch_of_little_text(docs):
    got = docs([(1, None), (2, ""), (3, "one"), (4, "One"), (5, "a b c d e")]).select(
        "doc_id", fingerprints.sketch(F.col("text")).alias("s")
    )
    found = {r.doc_id: r.s for r in got.collect()}
    assert found[1] == found[2] == [] and len(found[3]) == 1 and found[3] == found[4]
    assert len(found[5]) == 1


def test_sketches_of_short_parts(spark):
    words = [f"w{i}" for i in range(2000)]
    # all shingles of the joined text are in one of the two parts
    rows = [(" ".join(words), " ".join(words[at : at + n]), " ".join(words[at + n - 4 : at + n + 6]),
             " ".join(words[at : at + n + 6])) for n in range(5, 31) for at in range(0, 1900, 190)]
    df = spark.createDataFrame(rows, "whole string, part string, next string, joined string").select(
        *[fingerprints.sketch(F.col(c)).alias(c) for c in ("whole", "part", "next", "joined")]
    )
    got = df.select(
        "part", "joined", fingerprints.containment(F.col("part"), F.col("whole")).alias("inside"),
        fingerprints.merged(F.col("part"), F.col("next")).alias("merged"),
    ).collect()
    fallback = [min(r.part) >= 1 << 60 for r in got]
    assert 0 < sum(fallback) < len(got)
    assert [r.inside for r in got] == [None if f else 1.0 for f in fallback]
    assert all(r.merged == r.joined for r in got)


# --- sharding ---


@pytest.mark.parametrize("seed", range(8))
def test_cuts_are_minimax(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 60, int(rng.integers(1, 14)))
    shards = int(rng.integers(1, 6))
    cuts = sharding.cuts_for(sizes, shards)
    starts = [0, *cuts[:-1].tolist()]
    worst = max(sizes[a:b].sum() for a, b in zip(starts, cuts.tolist(), strict=True))
    best = [[0] + [10**9] * len(sizes)]
    for _ in range(shards):
        last = best[-1]
        best.append([0] + [min(max(last[k], sizes[k:n].sum()) for k in range(n + 1))
                           for n in range(1, len(sizes) + 1)])
    assert worst == best[-1][-1] and cuts[-1] == len(sizes)


def test_shards(docs):
    df = docs(EDGE + [(100 + i, f"text number {i} " * (i % 9)) for i in range(400)], clashing=True)
    got = sharding.shard(df, 5).collect()
    assert len(got) == df.count()
    by_crc, slots, sizes = defaultdict(set), defaultdict(list), Counter()
    for r in got:
        by_crc[r.text_crc32, r["size"]].add(r.shard)
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(len(s) == 1 for s in by_crc.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(5))


def test_even_shards(docs):
    df = docs([(i, f"text number {i} and so on") for i in range(4000)])
    sizes = Counter()
    for r in sharding.shard(df, 8).collect():
        sizes[r.shard] += r["size"]
    assert max(sizes.values()) <= 1.005 * sum(sizes.values()) / 8


@pytest.mark.parametrize("portion", [0.05, 0.1, 1 / 3])
def test_cuts_beside_a_large_group_are_even(portion):
    rng = np.random.default_rng(7)
    sizes = rng.integers(50, 150, 20_000)
    sizes[9_000] = sizes.sum() * portion / (1 - portion)
    cuts = sharding.cuts_for(sizes, 40)
    shards = [sizes[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]
    assert cuts[-1] == len(sizes)
    assert max(s.sum() for s in shards) == sizes[9_000]
    others = [s.sum() for s in shards if s.max(initial=0) < sizes[9_000]]
    assert len(others) == 39 and max(others) <= 1.08 * min(others)


def test_shards_beside_copies_are_even(docs):
    # a third of the rows is one text, a tenth another
    rows = [(i, "the first copied text" if i % 3 == 0 else "the second copied text"
             if i % 10 == 1 else f"number {i:07d} of the others") for i in range(6000)]
    sizes, copied = Counter(), defaultdict(set)
    texts = dict(rows)
    for r in sharding.shard(docs(rows), 40).collect():
        sizes[r.shard] += r["size"]
        if "copied" in texts[r.doc_id]:
            copied[texts[r.doc_id]].add(r.shard)
    assert sorted(map(len, copied.values())) == [1, 1]
    others = [n for shard, n in sizes.items() if {shard} not in copied.values()]
    assert len(others) == 38 and max(others) <= 1.05 * min(others)


# --- packing ---


def test_pieces_are_the_token_stream(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    rows = EDGE + [(50, "x <|endoftext|> y"), (51, "a  b\t c\r\n d")]
    got = small_pack(docs(rows, clashing=True)).collect()
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        documents[r.doc_id].append((r.start, ids, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, text in rows:
        if doc is None or doc == 7:
            continue
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        pieces = sorted(documents[doc])
        assert [i for _, ids, _ in pieces for i in ids] == want
        assert {n for _, _, n in pieces} == {len(want)}
    assert sorted(sequences) == list(range(len(sequences)))
    for number, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 64 or number == len(sequences) - 1


def test_fast_ids_are_the_tokenizers_ids():
    rng = np.random.default_rng(3)
    letters = list("ab  \n\n.,'sé¿1_ treÜ«!?0") + ["<|endoftext|>", "'re", "  \n ", "🙂", "\t"]
    fast, plain = packing.TextEncoder(VOCABULARY, RANKS), packing.TextEncoder(VOCABULARY)
    for _ in range(1500):
        text = "".join(rng.choice(letters, int(rng.integers(0, 30))))
        assert fast(text) == plain(text), text


# --- language ID ---


def test_forward_sums_all_segmentations():
    index = {"▁": 0, "a": 1, "b": 2, "ab": 3, "▁a": 4}
    probability = np.array([[0.1], [0.2], [0.3], [0.15], [0.25], [1e-7]])
    pieces = language_id.Pieces(index, probability, 2)
    ways = (0.1 * 0.2 * 0.3) + (0.25 * 0.3) + (0.1 * 0.15)
    assert np.exp(pieces.score(["ab"])[0, 0]) == pytest.approx(ways)
    assert np.exp(pieces.score(["c"])[0, 0]) == pytest.approx(0.1 * 1e-7)


def test_expected_counts_add_up():
    index = {"▁": 0, "a": 1, "b": 2, "ab": 3, "▁a": 4}
    pieces = language_id.Pieces(index, np.full((6, 1), 0.2), 2)
    counts = pieces.expected(["ab", "ba"], np.array([[2.0], [1.0]]))
    ways = {("▁", "a", "b"): 0.2**3, ("▁a", "b"): 0.2**2, ("▁", "ab"): 0.2**2}
    share = sum(p for w, p in ways.items() if "ab" in w) / sum(ways.values())
    assert counts[3, 0] == pytest.approx(2 * share)


def test_languages(docs):
    rows = [(1, None, None, "a"), (2, "", "en", "a"), (3, "123 !?", "en", "a")]
    rows += [(10 + i, "the cat and the dog of this house", "en", "a") for i in range(12)]
    rows += [(40 + i, "der Hund und die Katze im Haus", "de", "a") for i in range(12)]
    rows += [(70, "und der Hund", None, "a"), (None, "the house of the cat " * 9000, None, "a"),
             (71, "katze" * 3000, None, "a")]
    df = docs(rows, clashing=True)
    model = language_id.train(df, sample=100)
    got = {r.doc_id: r for r in language_id.predict(df, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3
    assert got[70].lang_pred == "de" and got[None].lang_pred == "en" and got[71].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = language_id.keep_known(df, model)
    assert kept.columns == df.columns and {1, 2, 3}.isdisjoint(r.doc_id for r in kept.collect())


# --- chat ---

TURNS = [
    (1, 0, "user", "\\### Assistant: </turn> ok"), (1, 1, "assistant", "ends with \\"),
    (1, 1, "assistant", "ends with \\"), (1, 2, None, None), (1, None, "sys:te\\m", "<turn>### x: "),
    (2, 0, "assistant", "#### four </turn>\n <turn"), (None, 5, "assistant", "x" * 3_000_000),
    (None, 6, "assistant", "y\n</turn>\n<turn>### user: z</turn>\n"), (3, 0, "<turn>\n", "\\\\"),
]


def test_chat_round_trip(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    formatted = chat.format_chats(df.selectExpr("*", "1 as part", "2 as loss")).collect()
    back = defaultdict(list)
    for row in sorted(formatted, key=lambda r: r.part):
        turns = chat.parse(row.text)
        assert len(turns) == row.n_turns
        back[row.conv_id] += [t[:2] for t in turns]
        assert [chat.unescape(row.text[s.start : s.end]) for s in row.loss] == [
            t[1] for t in turns if t[0] == "assistant"
        ]
    want = defaultdict(list)
    for conv, _, role, text in sorted(
        TURNS, key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")
    ):
        want[conv].append((role or "", text or ""))
    assert back == want
    assert len([r for r in formatted if r.conv_id is None]) == 2  # parts
    found = {r.conv_id: r for r in chat.digests(chat.format_chats(df)).collect()}
    learned = "".join(t for r, t in want[1] if r == "assistant")
    assert found[1].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    assert found[None].loss_chars == sum(len(t) for _, t in want[None])


def test_chat_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_chats(df)).collect() == []


def test_unescaped_control_strings_do_not_parse():
    for text in ("<turn>### user: a</turn>", "<turn>### user: <turn></turn>\n",
                 "<turn>### user: ### b</turn>\n", "user: a"):
        with pytest.raises(ValueError):
            chat.parse(text)
