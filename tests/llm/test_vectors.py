"""Whitening and nearest neighbours against plain numpy."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from storeledger.llm import neighbours, queries, whitening

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
KIND = "vec_id long, embedding array<double>"
ODD = [(9001, None), (9002, []), (9003, [1.0, None, 2.0]), (9004, [1.0, float("nan"), 2.0]),
       (9005, [float("inf"), 0.0, 0.0]), (9006, [1.0, 2.0])]


def plain_whitening(x, weights):
    """Of exact integers: components of rows, eigenvalue shares, deviations."""
    distinct, at, count = np.unique(x, axis=0, return_inverse=True, return_counts=True)
    w = count if weights == "count" else np.ones(len(distinct), int)
    n, total = int(w.sum()), (w[:, None] * distinct).sum(axis=0)
    c = (n * distinct - total) / n
    values, axes = np.linalg.eigh((c * w[:, None]).T @ c / n)
    values, axes = values[::-1], axes[:, ::-1]
    keep = values > 1e-12 * values[0]
    white = (c @ axes[:, keep]) / np.sqrt(values[keep])
    return n, white[at], values / values.sum(), ((n * distinct - total) ** 2).sum(axis=1)[at]


def check_whitening(rows, x, got, weights="one"):
    n, white, shares, deviations = plain_whitening(x, weights)
    by_id = {r.vec_id: r for r in got}
    ours = np.array([by_id[i].whitened for i in rows])
    theirs = white[:, : ours.shape[1]]
    theirs = theirs * np.sign((ours * theirs).sum(axis=0))
    assert np.abs(ours - theirs).max() < 1e-8
    assert [by_id[i].deviation for i in rows] == deviations.tolist()
    first = got[0]
    assert first.n == n and first.identity_error < 1e-9
    assert np.allclose(first.explained, shares[: len(first.explained)], rtol=1e-9)


def whole(vectors):
    return np.floor(64 * np.asarray(vectors, dtype=float)).astype(np.int64) + 1_000_000


@pytest.mark.parametrize("weights", ["one", "count"])
def test_whitening_of_copies_and_odd_rows(spark, weights):
    """A third of the rows is one vector; ids repeat; columns clash."""
    some = np.random.default_rng(1)
    vectors = np.concatenate([some.normal(size=(80, 3)) * [3, 1, 0.2], [[1.0, 2.0, 3.0]] * 40])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame([*rows, *ODD], KIND).selectExpr(
        "*", "1 as x", "2 as weight", "3 as whitened", "4 as n"
    )
    got = whitening.whiten(df, weights=weights).collect()
    assert len(got) == 120
    check_whitening(range(120), whole(vectors), got, weights)


def test_whitening_of_the_given_table(spark):
    given = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = queries.registry()["op12_whiten"](spark, SF).collect()
    assert len(rows) == 16 * len(given)
    by_id = {}
    for r in sorted(rows, key=lambda r: r.component):
        by_id.setdefault(r.vec_id, []).append(r)
    n, white, shares, deviations = plain_whitening(whole([r.embedding for r in given]), "one")
    ours = np.array([[c.whitened for c in by_id[r.vec_id]] for r in given])
    theirs = white[:, :16] * np.sign((ours * white[:, :16]).sum(axis=0))
    assert np.abs(ours - theirs).max() < 1e-8
    assert [by_id[r.vec_id][0].deviation for r in given] == deviations.tolist()
    assert {r.component for r in rows} == set(range(1, 17)) and {r.n for r in rows} == {n}
    assert np.allclose([c.explained for c in by_id[given[0].vec_id]], shares[:16])
    assert max(r.identity_error for r in rows) < 1e-4


def test_whitening_without_spread(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])], KIND)
    got = whitening.whiten(same).collect()
    assert [(r.n, r.deviation, r.whitened) for r in got] == [(1, 0, [])] * 3
    assert whitening.by_component(whitening.whiten(same)).collect() == []
    line = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(5)], KIND)
    assert {len(r.whitened) for r in whitening.whiten(line).collect()} == {1}
    none = spark.createDataFrame(ODD[:5], KIND)
    assert whitening.whiten(none).collect() == []
    assert whitening.whiten(spark.createDataFrame([], KIND)).collect() == []


def test_whitening_of_large_entries_is_exact(spark):
    rows = [(i, [2.0**44 * (i - 2), float(i * i)]) for i in range(5)] + [(9, [2.0**47, 1.0])]
    got = {r.vec_id: r for r in whitening.whiten(spark.createDataFrame(rows, KIND)).collect()}
    assert set(got) == set(range(5)) and got[0].deviation is None
    x = [[64 * int(a) + 10**6, 64 * int(b) + 10**6] for _, (a, b) in rows[:5]]
    total = [sum(c) for c in zip(*x, strict=True)]
    middle = sum((5 * v - s) ** 2 for v, s in zip(x[2], total, strict=True))
    assert got[2].deviation == middle


def plain_nearest(rows, query_ids, k=5):
    ids = np.array([i for i, _ in rows])
    v = np.array([x for _, x in rows], dtype=float)
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    out = {}
    for q in query_ids:
        scores = unit @ unit[ids == q][0]
        order = [j for j in np.lexsort((ids, -scores.round(12))) if ids[j] != q]
        out[q] = [(int(ids[j]), scores[j]) for j in order[:k]]
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(found, wanted):
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in own})
               for q, own in wanted.items())
    return hits / sum(map(len, wanted.values()))


def test_neighbours_of_the_given_table(spark):
    given = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding) for r in given]
    wanted = plain_nearest(rows, [i for i, _ in rows if i % 50 == 0])
    found = lists(queries.registry()["op13_neighbours"](spark, SF))
    assert set(found) == set(wanted) and recall(found, wanted) >= 0.9
    for q, own in found.items():
        exact = dict(plain_nearest(rows, [q], len(rows))[q])
        assert all(abs(exact[i] - s) < 1e-12 for i, s in own)
        assert own == sorted(own, key=lambda x: (-x[1], x[0]))


def test_recall_over_many_cells_and_slices(spark):
    """Isotropic vectors, the hardest case: 4,000 rows in cells of about 200."""
    some = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(some.normal(size=(4000, 32)))]
    df = spark.createDataFrame(rows, KIND)
    queried = df.where("vec_id % 50 = 0")
    wanted = plain_nearest(rows, range(0, 4000, 50))
    for cells in (1024, 2):  # two cells: each is searched in ten slices
        found = lists(neighbours.nearest(df, queried, cell_rows=200, most_cells=cells))
        assert recall(found, wanted) >= 0.9


def test_verified_share_and_stopping():
    """The stopping test leaves most of a clustered table unverified and keeps its recall."""
    some = np.random.default_rng(4)
    centres = some.normal(size=(40, 48))
    vectors = centres[some.integers(0, 40, 6000)] + 0.25 * some.normal(size=(6000, 48))
    projection = neighbours.Projection.fit(vectors[:2000], 48, 16, 1, 7)
    points = projection.project(vectors)
    tree = neighbours.Tree(np.arange(6000), vectors, points)
    factor = neighbours.chi_square_quantile(0.95, 16)
    rows = list(enumerate(vectors))
    wanted = plain_nearest(rows, range(0, 6000, 100))
    read, found = [], {}

    class Counting(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray):
                read.append(len(at))
            return np.asarray(np.ndarray.__getitem__(self, at))

    tree.vectors = tree.vectors.view(Counting)
    for q in wanted:
        lower = neighbours._squares_to(tree.boxes, points[q : q + 1])[0]
        best = tree.nearest(vectors[q], points[q], lower, 6, 4.0, factor)
        found[q] = [(i, -s) for s, i in best if i != q][:5]
    assert recall(found, wanted) >= 0.9
    assert sum(read) < 0.25 * 6000 * len(wanted)


def test_chi_square_quantiles():
    for share, freedom, value in ((0.95, 2, 5.991465), (0.95, 16, 26.296228), (0.5, 8, 7.344121)):
        assert abs(neighbours.chi_square_quantile(share, freedom) - value) < 1e-5


def test_neighbours_of_copies_ties_and_odd_rows(spark):
    """A third of the rows is one vector, scaled copies tie, ids repeat, columns clash."""
    some = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 2.0]) for i in range(0, 300, 3)]
    rows += [(i, some.normal(size=3).tolist()) for i in range(300) if i % 3]
    extra = [(0, [1.0, 2.0, 2.0]), (None, [1.0, 2.0, 2.0]), (8000, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame([*rows, *extra, *ODD], KIND).selectExpr(
        "*", "1 as q", "2 as cell", "3 as v", "4 as id", "5 as rank"
    )
    found = lists(neighbours.nearest(df, df.where("vec_id % 50 = 0"), cell_rows=64))
    wanted = plain_nearest(rows, range(0, 300, 50))
    assert set(found) == set(wanted)
    assert [i for i, _ in found[0]] == [3, 6, 9, 12, 15]
    assert [i for i, _ in found[150]] == [0, 3, 6, 9, 12]
    assert recall(found, wanted) >= 0.9
    immense = spark.createDataFrame([(0, [1e200, 0.0]), (1, [1e200, 1e200]), (2, [0.0, -1e-300])],
                                    KIND)
    got = lists(neighbours.nearest(immense, immense.where(F.col("vec_id") == 0)))
    assert [i for i, _ in got[0]] == [1, 2] and abs(got[0][0][1] - 0.5**0.5) < 1e-15


def test_neighbours_of_few_rows(spark):
    none = spark.createDataFrame([], KIND)
    assert neighbours.nearest(none, none).collect() == []
    one = spark.createDataFrame([(0, [1.0, 2.0])], KIND)
    assert neighbours.nearest(one, one).collect() == []
    assert neighbours.nearest(one, none).collect() == []
    two = spark.createDataFrame([(0, [1.0, 2.0]), (5, [2.0, 1.0])], KIND)
    assert [tuple(r)[:3] for r in neighbours.nearest(two, one).collect()] == [(0, 1, 5)]
