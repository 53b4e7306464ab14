"""Mixing sources to target weights.

Every document has a fixed point on a hash line. A source with target ``t`` and size ``s``
takes ``floor(t / s)`` whole copies of its documents and, once more, those whose point lies
below a threshold. The threshold comes from token sums per source and hash bucket: the bucket
in which the budget ends is found, and only that bucket is split into finer buckets, three
times. Nothing is sorted, a larger budget always takes a superset, and reruns agree because
points depend on the document alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.common import WORD, fresh, named, whole
from storeledger.staging import materialise

_BITS = 12  # buckets of a histogram: 4096 per source
_LEVELS = 3


def _targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """One row per source in, the same rows with ``target`` out.

    Shares what each source may take at most: sources whose limit is small for their weight
    take it whole, the others share the rest by weight. The table of sources is ordered in
    one task; it has one row per source, however many documents there are.
    """
    by_name = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    limit = F.col("source_size") * F.lit(float(most))
    fed = sizes.select(
        "source", "source_size", limit.alias("limit"),
        F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)).alias("weight"),
        (F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))).alias("total"),
    )
    up = Window.partitionBy().orderBy(
        F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    after = up.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum(
        "weight"
    ).over(after)
    levelled = fed.withColumn("level", level)
    open_level = F.min(
        F.when(
            F.col("limit") / F.col("weight") > F.col("level"),
            F.struct(F.col("limit") / F.col("weight"), "level"),
        )
    ).over(Window.partitionBy())["level"]
    return levelled.select(
        "source", "source_size",
        F.least("limit", F.coalesce(F.col("weight") * open_level, "limit")).alias("target"),
    )


def _bucket(point: Column, level: int) -> Column:
    """The first ``level + 1`` histogram digits of a point."""
    return F.shiftrightunsigned(point, 64 - _BITS * (level + 1))


def _cut(sized: DataFrame, cuts: DataFrame, level: int) -> DataFrame:
    """Refine, for every source, the bucket in which its budget ends."""
    inside = sized.withColumn("bucket", _bucket(F.col("point"), level))
    if level:
        inside = inside.withColumn("above", F.shiftright("bucket", _BITS))
    else:
        inside = inside.withColumn("above", F.lit(0).cast("long"))
    asked = cuts.select(F.col("source").alias("cut_source"), "edge", "left")
    sums = (
        inside.join(
            asked,
            F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("above") == F.col("edge")),
        )
        .groupBy("cut_source", "left", "bucket")
        .agg(F.sum("size").alias("tokens"))
    )
    running = Window.partitionBy("cut_source").orderBy("bucket")
    ends = (
        sums.withColumn("reach", F.sum("tokens").over(running))
        .where(F.col("reach") > F.col("left"))
        .groupBy("cut_source")
        .agg(F.min(F.struct("bucket", "reach", "tokens", "left")).alias("end"))
        .select(
            F.col("cut_source"), F.col("end.bucket").alias("new_edge"),
            (F.col("end.left") - F.col("end.reach") + F.col("end.tokens")).alias("new_left"),
            F.col("end.tokens").alias("tokens"),
        )
    )
    joined = cuts.drop("tokens").join(ends, F.col("source").eqNullSafe(F.col("cut_source")), "left")
    return joined.select(
        "source", "source_size", "target", "whole",
        # without an end nothing of the source is left to take
        F.coalesce("new_edge", F.lit(0).cast("long")).alias("edge"),
        F.coalesce("new_left", F.lit(0.0)).alias("left"), "tokens",
    )


def mix(
    docs: DataFrame,
    *,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """Decide how often each document is taken.

    Sources in code point order (null is a source, the last) weigh ``weights``, repeated, and
    share ``share`` times the words of all documents; a source is never taken more than
    ``most`` times over, and what it cannot take goes to the others by weight.

    Returns one row per row of ``docs``: ``doc_id, source, size, source_size, target, copies,
    taken, point`` with ``taken = size * copies``. A source's taken words miss its target by
    at most half of the last hash bucket, which is a single document but for ties. A null or
    empty text has size 0, and a source without words has target 0 and no copies. Rows that
    repeat id and text share a point, so they are taken alike. An empty table gives none.
    """
    sized = materialise(
        docs.select(
            named(id_column).alias("doc_id"),
            named(source_column).cast("string").alias("source"),
            F.regexp_count(whole(named(text_column)), F.lit(WORD)).cast("long").alias("size"),
            _point(id_column, text_column).alias("point"),
        ),
        "mix-sizes",
    )
    decided = _decided(sized, weights, share, most)
    return (
        sized.join(decided, F.col("source").eqNullSafe(F.col("cut_source")))
        .withColumn("copies", _copies(F.col("point")))
        .select(
            "doc_id", "source", "size", "source_size", "target", "copies",
            (F.col("size") * F.col("copies")).alias("taken"), "point",
        )
    )


def _point(id_column: str, text_column: str) -> Column:
    """A document's place on the hash line."""
    return F.xxhash64(named(id_column), whole(named(text_column)))


def _copies(point: Column) -> Column:
    """How often a document at ``point`` is taken, beside its source's row of ``_decided``."""
    once_more = _bucket(point, _LEVELS - 1) < F.col("threshold")
    return F.col("whole") + once_more.cast("long")


def _decided(
    sized: DataFrame, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """One row per source: ``cut_source, source_size, target, whole, threshold``."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    cuts = _targets(sizes, weights, share, most).select(
        "*", F.coalesce(copies, F.lit(0)).cast("long").alias("whole")
    )
    cuts = cuts.select(
        "*", F.lit(0).cast("long").alias("edge"),
        (F.col("target") - F.col("whole") * F.col("source_size")).alias("left"),
        F.lit(None).cast("long").alias("tokens"),
    )
    cuts = materialise(cuts, "mix-targets")
    for level in range(_LEVELS):
        cuts = materialise(_cut(sized, cuts, level), "mix-cuts")
    # the last bucket goes in when that comes nearer to the target
    threshold = F.col("edge") + F.when(F.col("left") * 2 >= F.col("tokens"), 1).otherwise(0)
    decided = cuts.select(
        F.col("source").alias("cut_source"), "source_size", "target", "whole",
        F.coalesce(threshold, F.lit(0)).alias("threshold"),
    )
    return materialise(decided, "mix-thresholds")


def take(
    docs: DataFrame,
    *,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as ``mix`` takes it, all columns kept.

    A row is decided on by its own hash and its source's threshold, so only the table of sources
    meets the texts. Documents without words carry no weight and stay once.
    """
    text = whole(named(text_column))
    sized = materialise(
        docs.select(
            named(source_column).cast("string").alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            _point(id_column, text_column).alias("point"),
        ),
        "mix-sizes",
    )
    decided = _decided(sized, weights, share, most).select("cut_source", "whole", "threshold")
    names = [fresh(docs, x) for x in ("mix_source", "mix_whole", "mix_threshold")]
    copy = fresh(docs, "mix_copy")
    once_more = (
        _bucket(_point(id_column, text_column), _LEVELS - 1) < F.col(names[2])
    ).cast("long")
    times = F.when(text.rlike(WORD), F.col(names[1]) + once_more).otherwise(1)
    return (
        docs.join(
            decided.toDF(*names),
            named(source_column).cast("string").eqNullSafe(F.col(names[0])),
        )
        .withColumn(copy, F.explode(F.array_repeat(F.lit(1), times.cast("int"))))
        .select(*[named(c) for c in docs.columns])
    )
