"""Nearest neighbours by cosine, from stable projections indexed by kd-trees.

Vectors of length one are projected on a few Gaussian directions (a 2-stable projection): the
squared distance of two projections, over the squared distance of the vectors, follows a
chi-square distribution with as many degrees of freedom as there are directions. A coarse
kd-tree, fitted on a bounded sample, cuts the projections of all vectors into cells, and each
cell has a kd-tree of its own. A query takes vectors in the order of their projected distances
and verifies them in full, until the next projected distance is so large that a vector nearer
than those found would show it with a chance below ``1 - confidence``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.common import named
from storeledger.llm.whitening import common_length, matrix
from storeledger.staging import materialise

_LEAF = 128  # vectors in a leaf of a cell's tree
_HASHES = 1 << 20


def chi_square_quantile(share: float, freedom: int) -> float:
    """The value below which a chi-square variable with an even ``freedom`` is with chance
    ``share``."""

    def above(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, freedom // 2):
            term *= x / 2 / i
            total += term
        return math.exp(-x / 2) * total

    low, high = 0.0, 2.0 * freedom + 200.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if above(middle) > 1 - share else (low, middle)
    return high


def usable(vector: Column) -> Column:
    """Neither null nor zero, and without null or non-finite entries."""
    finite = F.forall(
        vector, lambda e: e.isNotNull() & (F.abs(e.cast("double")) < float("inf"))
    )
    return (
        vector.isNotNull() & F.coalesce(finite, F.lit(False))
        & F.coalesce(F.exists(vector, lambda e: e != 0), F.lit(False))
    )


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each row by a power of two, so that squares neither overflow nor vanish."""
    _, power = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -power[:, None])


def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def _squares_to(boxes: tuple[np.ndarray, np.ndarray], points: np.ndarray) -> np.ndarray:
    """Squared distances of points (rows) to boxes (columns)."""
    low, high = boxes
    out = np.zeros((len(points), len(low)))
    for i in range(points.shape[1]):
        p = points[:, i, None]
        gap = np.maximum(np.maximum(low[None, :, i] - p, p - high[None, :, i]), 0.0)
        out += gap * gap
    return out


@dataclass(frozen=True)
class Projection:
    """Gaussian directions and the planes of the coarse tree, in heap order."""

    directions: np.ndarray
    axes: np.ndarray
    values: np.ndarray

    @property
    def cells(self) -> int:
        return len(self.axes) + 1

    @staticmethod
    def fit(sample: np.ndarray, width: int, dims: int, cells: int, seed: int) -> Projection:
        directions = np.random.default_rng(seed).normal(size=(width, dims))
        axes, values = np.zeros(cells - 1, np.int64), np.zeros(cells - 1)
        made = Projection(directions, axes, values)
        groups = {0: made.project(np.unique(sample, axis=0))}
        for node in range(cells - 1):
            points = groups.pop(node)
            if len(points):
                axis = int(np.ptp(points, axis=0).argmax())
                axes[node], values[node] = axis, np.median(points[:, axis])
            right = points[:, axes[node]] > values[node]
            groups[2 * node + 1], groups[2 * node + 2] = points[~right], points[right]
        return made

    def project(self, vectors: np.ndarray) -> np.ndarray:
        vectors = _scaled(vectors)
        return (vectors / _norms(vectors)[:, None]) @ self.directions

    def cell(self, points: np.ndarray) -> np.ndarray:
        node, every = np.zeros(len(points), np.int64), np.arange(len(points))
        while self.cells > 1 and node.min(initial=self.cells) < self.cells - 1:
            node = 2 * node + 1 + (points[every, self.axes[node]] > self.values[node])
        return node - (self.cells - 1)


class Tree:
    """The kd-tree of one slice of a cell, kept as its leaves and their boxes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray):
        order, leaves = [], []
        waiting = [np.arange(len(ids))]
        while waiting:
            part = waiting.pop()
            if len(part) > _LEAF:
                own = points[part]
                axis = int(np.ptp(own, axis=0).argmax())
                ranked = part[np.argpartition(own[:, axis], len(part) // 2)]
                waiting += [ranked[: len(part) // 2], ranked[len(part) // 2 :]]
            else:
                leaves.append(len(part))
                order.append(part)
        order = np.concatenate(order)
        self.ids, self.points = ids[order], points[order]
        self.vectors = _scaled(vectors[order])
        self.norms = _norms(self.vectors)
        self.ends = np.cumsum(leaves)
        self.starts = self.ends - leaves
        self.boxes = (
            np.minimum.reduceat(self.points, self.starts),
            np.maximum.reduceat(self.points, self.starts),
        )

    def nearest(
        self, vector: np.ndarray, point: np.ndarray, lower: np.ndarray, most: int,
        bound: float, factor: float,
    ) -> list[tuple[float, int]]:
        """The best ``most`` pairs of -score and id, of different ids.

        ``lower`` has the squared distances of the leaves; ``bound`` is a squared distance
        within which ``most`` vectors are known already.
        """
        leaves, norm = np.argsort(lower), _norms(vector[None])[0]
        found: dict[int, float] = {}
        best: list[tuple[float, int]] = []
        far, apart = np.empty(0), np.empty(0, np.int64)
        at, take = 0, 2
        while True:
            frontier = lower[leaves[at]] if at < len(leaves) else np.inf
            ready = int(np.searchsorted(far, frontier, "right"))
            if not ready:
                if at == len(leaves) or frontier > factor * bound:
                    return best
                chosen = leaves[at : at + take]
                at, take = at + take, 2 * take
                rows = np.concatenate(
                    [np.arange(self.starts[x], self.ends[x]) for x in chosen]
                )
                gap = self.points[rows] - point
                distance = (gap * gap).sum(axis=1)
                near = distance <= factor * bound
                far = np.concatenate([far, distance[near]])
                apart = np.concatenate([apart, rows[near]])
                order = np.argsort(far, kind="stable")
                far, apart = far[order], apart[order]
                continue
            done = 0
            while done < ready:
                if far[done] > factor * bound:
                    return best  # what is next is too far for a nearer vector
                some = slice(done, min(ready, done + 64))
                rows = apart[some]
                scores = (self.vectors[rows] * vector).sum(axis=1) / (self.norms[rows] * norm)
                worst = -best[-1][0] if len(best) == most else -np.inf
                for i in np.flatnonzero(scores >= worst).tolist():
                    key = int(self.ids[rows[i]])
                    found[key] = max(found.get(key, -2.0), float(scores[i]))
                best = sorted((-s, k) for k, s in found.items())[:most]
                found = {k: -s for s, k in best}
                if len(best) == most:
                    bound = min(bound, 2 + 2 * best[-1][0])
                done = some.stop
            far, apart = far[ready:], apart[ready:]


_PLACED = "cell int, slice int, asks int, id long, v {vector}, p array<double>, bound double"
_FOUND = (
    "q long, v {vector}, p array<double>, cell int, slice int, ids array<long>,"
    " scores array<double>"
)


def _search(
    places: DataFrame, asked: DataFrame, vector: str, width: int, dims: int, most: int,
    factor: float,
) -> DataFrame:
    """Vectors and queries meet in their cell's slice: the vectors come first and make its
    tree, the queries are streamed past it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, tree = None, [], None
        for batch in batches:
            cells, slices, asks, ids = (batch.column(i).to_numpy() for i in range(4))
            vectors = matrix(batch.column(4), width)
            points = matrix(batch.column(5), dims)
            bounds = batch.column(6).to_numpy(zero_copy_only=False)
            change = np.flatnonzero(
                np.any([np.diff(c) != 0 for c in (cells, slices, asks)], axis=0)
            ) + 1
            for start, end in zip([0, *change], [*change, len(ids)], strict=True):
                if start == end:
                    continue
                some = slice(start, end)
                key = (int(cells[start]), int(slices[start]))
                if key != current:
                    current, parts, tree = key, [], None
                if not asks[start]:
                    parts.append((ids[some], vectors[some], points[some]))
                    continue
                if tree is None and parts:
                    tree, parts = Tree(*map(np.concatenate, zip(*parts, strict=True))), []
                scaled = _scaled(vectors[some])
                for first in range(0, end - start, 256):
                    few = slice(first, min(end - start, first + 256))
                    lists = [[] for _ in range(few.stop - first)]
                    if tree is not None:
                        lower = _squares_to(tree.boxes, points[some][few])
                        lists = [
                            tree.nearest(v, p, far, most, bound, factor)
                            for v, p, far, bound in zip(
                                scaled[few], points[some][few], lower, bounds[some][few],
                                strict=True,
                            )
                        ]
                    own = batch.slice(start + first, few.stop - first)
                    yield pa.RecordBatch.from_arrays(
                        [
                            own.column(3), own.column(4), own.column(5), own.column(0),
                            own.column(1),
                            pa.array([[k for _, k in x] for x in lists], pa.list_(pa.int64())),
                            pa.array([[-s for s, _ in x] for x in lists],
                                     pa.list_(pa.float64())),
                        ],
                        names=["q", "v", "p", "cell", "slice", "ids", "scores"],
                    )

    met = places.unionByName(asked).repartition("cell", "slice")
    return met.sortWithinPartitions("cell", "slice", "asks").mapInArrow(
        run, _FOUND.format(vector=vector)
    )


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    k: int = 5,
    dims: int = 16,
    confidence: float = 0.95,
    cell_rows: int = 8192,
    most_cells: int = 1024,
    sample_rows: int = 20_000,
    seed: int = 7,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest found of each query among all vectors but those with its own id.

    Returns ``query_id, rank, vec_id, score``: the cosine of the given vectors, largest first,
    ties by the smaller id; fewer rows where there are fewer vectors. The planes of the coarse
    tree come from a sample of at most ``sample_rows`` vectors, all vectors are indexed. A cell
    that holds more than ``cell_rows`` vectors is searched in slices of about that size, at most
    ``most_cells`` cells are described on the driver. ``dims`` must be even.

    Of equal vectors the ``k + 1`` smallest ids are indexed, which are all that can be among
    ``k`` nearest; equal queries are searched once. Rows with a null id, a null, empty or zero
    vector, null or non-finite entries, or another length than most vectors have (the larger
    one of equally frequent lengths) take no part. Rows that repeat an id and a vector are one;
    of rows that share an id only, the nearest counts. An empty table gives none.
    """
    if dims < 2 or dims % 2:
        raise ValueError(f"dims must be even, got {dims}")
    spark = vectors.sparkSession

    def chosen(df: DataFrame) -> DataFrame:
        own = df.select(
            named(id_column).cast("long").alias("id"), named(vector_column).alias("v")
        )
        return own.where(F.col("id").isNotNull() & usable(F.col("v")))

    given = chosen(vectors)
    vector = given.schema["v"].dataType.simpleString()
    width = common_length(given, "v")
    if width is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    given = given.where(F.size("v") == width)

    # the smallest ids of equal vectors; the limit is applied before the shuffle too
    same = Window.partitionBy("v").orderBy("id")
    points = (
        given.dropDuplicates(["id", "v"]).withColumn("nth", F.row_number().over(same))
        .where(F.col("nth") <= k + 1).drop("nth")
    )
    points = materialise(points, "distinct-points")
    n = points.count()
    share = min(_HASHES, math.ceil(2 * sample_rows / n * _HASHES))
    sample = points.where(F.pmod(F.xxhash64("id"), F.lit(_HASHES)) < share).limit(sample_rows)
    sampled = sample.select(F.col("v").cast("array<double>").alias("v")).toArrow()
    depth = min(int(math.log2(most_cells)), max(0, math.ceil(math.log2(n / cell_rows))))
    projection = Projection.fit(
        matrix(sampled.column("v").combine_chunks(), width), width, dims, 1 << depth, seed
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            projected = projection.project(matrix(batch.column(1), width))
            ends = np.arange(len(projected) + 1, dtype=np.int32) * dims
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(projected.ravel())),
                    pa.array(projection.cell(projected).astype(np.int32)),
                ],
                names=["id", "v", "p", "cell"],
            )

    kinds = f"id long, v {vector}, p array<double>, cell int"
    placed = materialise(points.mapInArrow(place, kinds), "placed")
    ranges = [f(F.col("p")[i]).alias(f"{name}{i}")
              for i in range(dims) for name, f in (("low", F.min), ("high", F.max))]
    known = placed.groupBy("cell").agg(F.count("*").alias("rows"), *ranges).collect()
    slices = np.zeros(projection.cells, np.int64)
    low = np.full((projection.cells, dims), np.inf)
    high = np.full((projection.cells, dims), np.inf)
    for row in known:
        slices[row["cell"]] = math.ceil(row["rows"] / cell_rows)
        low[row["cell"]] = [row[f"low{i}"] for i in range(dims)]
        high[row["cell"]] = [row[f"high{i}"] for i in range(dims)]

    per_cell = F.array(*map(F.lit, slices.tolist()))
    slice_of = F.pmod(F.xxhash64("id", F.lit(1)), F.greatest(per_cell[F.col("cell")], F.lit(1)))
    places = placed.select(
        "cell", slice_of.cast("int").alias("slice"), F.lit(0).alias("asks"), "id", "v", "p",
        F.lit(None).cast("double").alias("bound"),
    )
    wanted = chosen(queries).where(F.size("v") == width)
    numbered = materialise(
        wanted.groupBy("v").agg(F.count("*").alias("id")).select(
            F.monotonically_increasing_id().alias("id"), "v"
        ),
        "queries",
    )  # written once, so that the numbers stay
    homes = numbered.mapInArrow(place, kinds).select(
        "cell", F.lit(0).alias("slice"), F.lit(1).alias("asks"), "id", "v", "p",
        F.lit(4.0).alias("bound"),
    )
    factor = chi_square_quantile(confidence, dims)
    search = (vector, width, dims, k + 1, factor)
    found = materialise(_search(places, homes, *search), "found-at-home")
    if slices.sum() > 1:

        def onward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Queries for every other slice whose box is within reach."""
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    few = batch.slice(at, 256)
                    scores = few.column("scores").to_pylist()
                    bound = np.array([2 - 2 * s[k] if len(s) > k else 4.0 for s in scores])
                    reach = _squares_to((low, high), matrix(few.column("p"), dims))
                    query, cell = np.nonzero(reach <= factor * bound[:, None])
                    query = np.repeat(query, slices[cell])
                    part = np.concatenate([np.arange(slices[c]) for c in cell] or [cell])
                    cell = np.repeat(cell, slices[cell])
                    home = few.column("cell").to_numpy()[query]
                    other = (cell != home) | (part != few.column("slice").to_numpy()[query])
                    query, cell, part = query[other], cell[other], part[other]
                    for first in range(0, len(query), 4096):
                        some = slice(first, first + 4096)
                        own = few.take(pa.array(query[some]))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(cell[some].astype(np.int32)),
                                pa.array(part[some].astype(np.int32)),
                                pa.array(np.ones(len(query[some]), np.int32)),
                                own.column("q"), own.column("v"), own.column("p"),
                                pa.array(bound[query[some]]),
                            ],
                            names=["cell", "slice", "asks", "id", "v", "p", "bound"],
                        )

        more = found.mapInArrow(onward, _PLACED.format(vector=vector))
        found = found.unionByName(_search(places, more, *search))

    pairs = found.select("q", F.explode(F.arrays_zip("ids", "scores")).alias("hit")).select(
        "q", F.col("hit.ids").alias("vec_id"), F.col("hit.scores").alias("score")
    )
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    lists = (
        pairs.groupBy("q", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1)
    )
    hits = materialise(
        lists.groupBy("q").agg(
            F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("hits")
        ).join(numbered.withColumnRenamed("id", "q"), "q"),
        "hits",
    )
    ours = F.filter("hits", lambda h: h["vec_id"] != F.col("id"))
    return (
        wanted.dropDuplicates(["id", "v"]).join(hits, "v")
        .select("id", F.posexplode(F.slice(ours, 1, k)).alias("at", "hit"))
        .select(
            F.col("id").alias("query_id"), (F.col("at") + 1).alias("rank"),
            F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"),
        )
    )
