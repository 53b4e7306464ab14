"""Hot groups, repeated ids, bounds and recall."""

from __future__ import annotations

import contextlib
import hashlib
import io
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from storeledger.llm import (
    chat, fingerprints, language_id, licenses, mixing, near_join,
)
from tests.llm.conftest import EDGE, LONG, SAID
from tests.llm.test_small import near_texts, plain_components

OTHER = "there is nothing in common between this text and all the others of the table"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


# --- licenses ---


def damaged(template: licenses.Template, share: float, rng) -> str:
    """The template with words replaced until ``share`` of its shingles is left."""
    words = [s.split()[0] for s in template.shingles] + template.shingles[-1].split()[1:]
    size, own = len(template.shingles), set(template.shingles)
    while True:
        changed = list(words)
        at = int(rng.integers(len(words)))
        changed[at] = f"changed{rng.integers(10**6)}"
        left = {" ".join(changed[i : i + 5]) for i in range(len(changed) - 4)} & own
        if len(left) < share * size:
            return " ".join(words)
        words = changed


def test_recall_of_the_bands_for_long_templates(docs):
    """Windows with 0.8 to 0.95 of a template's shingles, against a search without bands."""
    rng = np.random.default_rng(11)
    texts = licenses.TEMPLATES | licenses.MORE_TEMPLATES
    long = [t for t in (licenses.template(*x) for x in texts.items()) if len(t.shingles) > 20]
    assert len(long) >= 6

    def around() -> str:
        return " ".join(f"w{rng.integers(5000)}" for _ in range(int(rng.integers(0, 60))))

    rows = [
        (i, f"{around()} {damaged(long[i % len(long)], rng.uniform(0.8, 0.95), rng)} {around()}")
        for i in range(2400)
    ]
    table = docs(rows)
    whole = licenses.matched(table.select("doc_id", "text"), long)
    want = {(r.doc_id, r.license) for r in whole.collect()}
    got = {(r.doc_id, r.license) for r in licenses.scan(table, texts).collect()}
    assert len(want) >= 2300  # what is planted is there for the plain search
    recall = len(want & got) / len(want)
    print(f"recall of the bands: {recall:.4f} of {len(want)}")
    assert recall >= 0.99


def test_licenses_of_edge_rows(docs):
    mit, short = licenses.TEMPLATES["mit-permission"], "All rights reserved."
    found = {"mit-permission", "all-rights-reserved"}
    rows = EDGE + [(21, f"{LONG} {mit} {LONG} {short}"), (22, mit), (22, mit), (None, short),
                   (23, f"{short} {short}"), (24, "rights reserved")]
    got = Counter((r.doc_id, r.license) for r in licenses.scan(docs(rows, clashing=True)).collect())
    assert {name for doc, name in got if doc == 21} == found
    assert got[22, "mit-permission"] == 2  # a repeated row gives its rows
    assert got[None, "all-rights-reserved"] == 1 and got[23, "all-rights-reserved"] == 1
    assert {doc for doc, _ in got} == {21, 22, 23, None}


# --- near join ---


def test_keep_one_drops_by_id_and_set(docs):
    rows = [(1, SAID), (5, SAID + " more"), (5, OTHER), (7, OTHER), (7, SAID), (None, OTHER),
            (9, None), (9, ""), (2, "a b"), (3, "a b")]
    kept = near_join.keep_one(docs(rows, clashing=True))
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert got == Counter([(1, SAID), (5, OTHER), (None, OTHER), (9, None), (9, ""), (2, "a b")])


def test_repeated_ids_are_linked_in_components(docs):
    rows = [(1, SAID), (5, SAID + " more"), (5, OTHER), (9, OTHER), (6, "x y z")]
    got = Counter(map(tuple, near_join.near_components(docs(rows)).collect()))
    assert got == plain_components(rows, 5, 80)
    assert {c for _, _, c in got} == {1, 6}


def test_links_as_brute_force(docs, monkeypatch):
    rows = [(i, text) for i, (_, text) in enumerate(near_texts())]
    rows += [(5000 + i, t) for i, (d, t) in enumerate(EDGE) if d]
    links, members = near_join.near_links(docs(rows, clashing=True), width=5, percent=80)
    sets = {d: frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))
            for d, t in rows if (w := (t or "").lower().split())}
    want = {
        (a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        for a in sets for b in sets
        if a < b and len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b])
    }
    of = {r.doc_id: r.class_id for r in members.collect()}
    assert set(of) == set(sets)
    by_class = defaultdict(set)
    for doc, number in of.items():
        by_class[number].add(doc)
    assert all(len({sets[d] for d in own}) == 1 for own in by_class.values())
    got = {}
    for r in links.collect():
        for a in by_class[r.a]:
            for b in by_class[r.b]:
                got[min(a, b), max(a, b)] = r.shared / r.all_tokens
    for own in by_class.values():
        got |= {(a, b): 1.0 for a in own for b in own if a < b}
    assert got == want and len(want) > 500
    counts = Counter(d for pair in want for d in pair)
    found = {r.doc_id: r.n_links for r in near_join.link_counts(links, members).collect()}
    assert found == {d: counts[d] for d in sets}


def test_frequent_tokens_come_last(docs):
    """Counts of the tokens that most documents share are exact; they lead no prefix."""
    rng = np.random.default_rng(1)
    shared = "these are the words that begin each of the documents here"
    rows = [(i, shared + " " + " ".join(f"v{rng.integers(10**6)}" for _ in range(40)))
            for i in range(400)]
    texts = docs(rows).select(F.col("doc_id").alias("doc"), "text")
    counts = near_join._token_counts(texts, 5)
    common = near_join.Shingler(5).sets([shared])[0]
    uses, frequent = counts.of(common)
    assert frequent.all() and set((uses - (1 << 40)).tolist()) == {400}
    prepared = texts.withColumn("said", F.md5("text"))
    for r in near_join._prefixes(prepared, counts, 5, 80).collect():
        assert not set(r.first) & set(common.view(np.int64).tolist())


# --- mixing ---


def test_take_moves_no_text(spark, docs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        text = plan(mixing.take(docs([(i, f"some text {i}") for i in range(50)])))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = text.split("\nExchange")[1:] + text.split(") Exchange")[1:]
    assert not any("text" in e.split("\n\n")[0] for e in exchanges)


def test_take_agrees_with_mix(docs):
    rows = EDGE + [(100 + i, " ".join(["w"] * (i % 17))) for i in range(200)]
    df = docs(rows, clashing=True)
    decided = mixing.mix(df).collect()
    times = Counter()
    for r in decided:
        times[r.doc_id] += r.copies if r["size"] else 1
    assert Counter(r.doc_id for r in mixing.take(df).collect()) == +times


# --- fingerprints ---


@pytest.mark.parametrize("hot", [7, None])
def test_next_of_a_hot_id(spark, docs, hot):
    """Half of the rows share one id: many blocks, the same order."""
    rows = [(hot, f"said {i} of many") for i in range(400)]
    rows += [(i, f"other {i}") for i in range(1, 401) if i != 7]
    table = docs(rows).select("doc_id", "text")
    hashed = table.withColumn("point", F.xxhash64("text")).collect()
    order = sorted(hashed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.point))[::-1]
    want = {(a.doc_id, a.text): b.text for a, b in zip(order, order[1:] + order[:1], strict=True)}
    got = {(r.doc_id, r.text): r.next_text for r in fingerprints.with_next(table).collect()}
    assert got == want
    blocks = fingerprints._blocks(table, 16).groupBy("block").count().collect()
    assert len(blocks) > 8 and max(r["count"] for r in blocks) < 300


def test_next_of_edge_rows(docs):
    table = docs(EDGE).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    hashed = table.withColumn("point", F.xxhash64("text")).collect()
    order = sorted(hashed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.point))[::-1]
    want = Counter((a.doc_id, a.text, b.text)
                   for a, b in zip(order, order[1:] + order[:1], strict=True))
    got = Counter((r.doc_id, r.text, r.next_text)
                  for r in fingerprints.with_next(table).collect())
    assert got == want


# --- language ID ---


def test_the_sample_is_bounded_by_different_texts(docs, monkeypatch):
    """Half of the rows of each language are one copied text: it counts once."""
    rng = np.random.default_rng(2)
    languages = [f"l{i}" for i in range(6)]
    rows = []
    for i, lang in enumerate(languages):
        words = [chr(97 + i) + chr(97 + k) for k in range(26)]
        copied = " ".join(rng.choice(words, 30))
        for n in range(1200):
            own = " ".join(rng.choice(words, 8))
            rows.append((len(rows), copied if n % 2 else f"{own} {n}", lang, "s"))
    written = {}
    real = language_id.materialise

    def noting(df, label):
        written[label] = df
        return real(df, label)

    monkeypatch.setattr(language_id, "materialise", noting)
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]
    model = language_id.train(docs(rows), letters, sample=50, rounds=1)
    assert model.languages == languages
    uses = written["language-words"].groupBy("lang").agg(F.sum("uses").alias("u")).collect()
    # every text has 8 words, the copied one 30: letters only are words
    assert all(50 * 8 <= r.u <= 50 * 8 + 22 for r in uses)


# --- chat ---


def test_a_hot_conversation_is_cut_into_parts(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"turn {i} </turn>") for i in range(3000)]
    rows += [(c, t, "assistant", f"{c} {t}") for c in range(2, 300) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        formatted = chat.format_chats(df)
        parts = formatted.groupBy("conv_id").agg(F.count("*").alias("n")).collect()
        assert {r.conv_id: r.n for r in parts}[1] > 1
        assert formatted.where("whole").count() > 250
        got = {r.conv_id: r for r in chat.digests(formatted).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 299
    said = "".join(f"{r}\n{t}\n" for c, _, r, t in rows if c == 1)
    learned = "".join(t for c, _, r, t in rows if c == 1 and r == "assistant")
    assert got[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    assert got[1].n_turns == 3000 and got[2].n_turns == 3
