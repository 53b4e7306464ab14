"""Embedding whitening with weighted multiplicity covariance.

Equal vectors of whole numbers are grouped, and the fit gives each distinct vector the weight of
one or of its copies. Sums of the vectors are exact. The covariance is a weighted product of
centred batches, added up by Spark; its eigenvectors come from a d x d matrix, the only thing
besides the sums that reaches the driver. Each distinct vector is whitened once and joined back
to its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.llm.common import named
from storeledger.staging import materialise

SCALE, SHIFT = 64, 1_000_000
_LARGEST = 2.0**46  # entries below this are exact when scaled
_SMALLEST_SHARE = 1e-12  # of the largest eigenvalue: less is rounding, not spread

_RESULT = (
    "vec_id {key}, n long, deviation long, whitened array<double>, explained array<double>,"
    " identity_error double"
)


def usable(vector: Column) -> Column:
    """Neither null nor empty, and without null, non-finite or immense entries."""
    plain = F.forall(vector, lambda e: e.isNotNull() & (F.abs(e.cast("double")) < _LARGEST))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(plain, F.lit(False))


def whole_numbers(vector: Column) -> Column:
    return F.transform(vector, lambda e: F.floor(e.cast("double") * SCALE) + F.lit(SHIFT))


def common_length(vectors: DataFrame, column: str) -> int | None:
    """The length most vectors have, the larger one of equally frequent ones."""
    counts = vectors.groupBy(F.size(column).alias("length")).count()
    first = counts.orderBy(F.desc("count"), F.desc("length")).first()
    return first and first["length"]


def matrix(column: pa.Array, width: int, kind=np.float64) -> np.ndarray:
    """A list column of one length as rows of a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(kind, copy=False).reshape(-1, width)


def _integer_sums(weights: np.ndarray, x: np.ndarray) -> list[int]:
    if int(np.abs(x).max(initial=0)) * int(weights.sum()) < 2**62:
        return (weights @ x).tolist()
    return (weights.astype(object) @ x.astype(object)).tolist()


def _sums(distinct: DataFrame, width: int) -> tuple[int, list[int]]:
    """Total weight and exact weighted sums per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * width
        for batch in batches:
            weights = batch.column("weight").to_numpy()
            part = _integer_sums(weights, matrix(batch.column("x"), width, np.int64))
            n, total = n + int(weights.sum()), [a + b for a, b in zip(total, part, strict=True)]
        yield pa.RecordBatch.from_pydict(
            {"dimension": pa.array(range(-1, width), pa.int32()),
             "total": pa.array([str(v) for v in [n, *total]])}
        )

    parts = distinct.select("weight", "x").mapInArrow(run, "dimension int, total string")
    rows = parts.groupBy("dimension").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("s"))
    found = {r["dimension"]: int(r["s"]) for r in rows.collect()}
    return found.get(-1, 0), [found.get(i, 0) for i in range(width)]


def _products(
    frame: DataFrame, column: str, width: int, centred: Callable[[np.ndarray], np.ndarray]
) -> np.ndarray:
    """Weighted sum of the outer products of centred rows.

    Every task adds up its own matrix; Spark adds the matrices up entry by entry.
    """
    row, other = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            c = centred(batch.column(column))
            total += (c * batch.column("weight").to_numpy()[:, None]).T @ c
        yield pa.RecordBatch.from_arrays(
            [pa.array(row.astype(np.int32)), pa.array(other.astype(np.int32)),
             pa.array(total[row, other])],
            names=["i", "j", "value"],
        )

    parts = frame.select("weight", column).mapInArrow(run, "i int, j int, value double")
    out = np.zeros((width, width))
    for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["value"]
    return out


def _principal(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, largest entry positive."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    spread = values > _SMALLEST_SHARE * max(values[0], 0.0)
    keep = min(most, int(spread.sum()))
    vectors = vectors[:, :keep]
    largest = np.abs(vectors).argmax(axis=0)
    return values[:keep], vectors * np.sign(vectors[largest, np.arange(keep)])


def _deviations(n: int, offsets: np.ndarray, rest: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, null where it is no long."""
    far = n * int(np.abs(offsets).max(initial=0)) + n
    if far * far * offsets.shape[1] < 2**62:
        t = n * offsets - rest
        return (t * t).sum(axis=1).tolist()
    t = n * offsets.astype(object) - rest.astype(object)
    return [v if v < 2**63 else None for v in (t * t).sum(axis=1).tolist()]


def whiten(
    vectors: DataFrame,
    *,
    weights: str = "one",
    components: int = 16,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Whitened principal components of every row's vector.

    An entry c counts as x = floor(64 * c) + 1000000. Distinct x are fitted with a weight of
    ``one`` each or of the ``count`` of their rows, and n is the sum of the weights. Returns
    ``vec_id, n, deviation, whitened, explained, identity_error``: the projections of x - S/n on
    the unit eigenvectors of the covariance, over the roots of the eigenvalues, largest first;
    their shares of the trace; and the largest entry of the covariance of the whitened vectors
    less the identity, measured on all of them.

    Rows are left out whose vector is null or empty, holds null or non-finite entries or entries
    of 2^46 and more, or is not as long as most vectors are (of equally frequent lengths the
    larger one counts). Components without spread are left out, all of them where all vectors
    are equal. A deviation too large for a long is null. Rows that repeat an id, also a null
    one, stay; extra columns are ignored; an empty table gives none.
    """
    if weights not in ("one", "count"):
        raise ValueError(f"weights must be 'one' or 'count', got {weights!r}")
    spark = vectors.sparkSession
    given = vectors.select(
        named(id_column).alias("vec_id"), named(vector_column).alias("vector")
    ).where(usable(F.col("vector")))
    schema = _RESULT.format(key=given.schema["vec_id"].dataType.simpleString())
    width = common_length(given, "vector")
    if width is None:
        return spark.createDataFrame([], schema)
    rows = given.where(F.size("vector") == width).select(
        "vec_id", whole_numbers(F.col("vector")).alias("x")
    )
    weight = F.lit(1).cast("long") if weights == "one" else F.count("*")
    distinct = materialise(rows.groupBy("x").agg(weight.alias("weight")), "distinct-vectors")

    n, sums = _sums(distinct, width)
    base = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n for s in sums], dtype=np.int64)

    def centred(column: pa.Array) -> np.ndarray:
        return (matrix(column, width, np.int64) - base) - rest / n

    covariance = _products(distinct, "x", width, centred) / n
    values, axes = _principal(covariance, components)
    to_white, kept = axes / np.sqrt(values), len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x")
            white = centred(x) @ to_white
            ends = np.arange(len(x) + 1, dtype=np.int32) * kept
            yield pa.RecordBatch.from_arrays(
                [
                    x, batch.column("weight"),
                    pa.array(
                        _deviations(n, matrix(x, width, np.int64) - base, rest), pa.int64()
                    ),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(white.ravel())),
                ],
                names=["x", "weight", "deviation", "whitened"],
            )

    white = materialise(
        distinct.mapInArrow(
            run, "x array<long>, weight long, deviation long, whitened array<double>"
        ),
        "whitened",
    )
    error = 0.0
    if kept:
        means = white.agg(
            *[F.sum(F.col("whitened")[i] * F.col("weight")).alias(f"m{i}") for i in range(kept)]
        ).first()
        mean = np.array(means) / n
        spread = _products(white, "whitened", kept, lambda c: matrix(c, kept) - mean) / n
        error = float(np.abs(spread - np.eye(kept)).max())
    explained = (values / np.trace(covariance)).tolist() if kept else []
    return rows.join(white, "x").select(
        "vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*map(F.lit, explained)).cast("array<double>").alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def by_component(whitened: DataFrame) -> DataFrame:
    """One row per vector and component, numbered from 1."""
    values = F.arrays_zip("whitened", "explained")
    return whitened.select(
        "vec_id", "n", "deviation", "identity_error", F.posexplode(values).alias("at", "value")
    ).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation",
        F.col("value.whitened").alias("whitened"), F.col("value.explained").alias("explained"),
        "identity_error",
    )
