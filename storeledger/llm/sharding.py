"""Sharding by minimax contiguous partition.

Documents with equal texts form a group that is never split. Groups lie on a line ordered by
the hash of their text. The sizes along the line are summed in a fixed number of cells, in each
of which equal texts are together. The smallest capacity that a greedy walk can fill into the
given number of shards is found by binary search. Among the cuts feasible under it those are
taken that give shards of nearly equal size. Groups above an even share come first on the line,
so that the others are one stretch, which can be cut evenly. Cells next to a cut are then split
into finer cells and the search is repeated, so cuts end up between groups.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.common import named, whole
from storeledger.staging import materialise

_BITS = 16  # cells of the first search: 65,536 sums on the driver, whatever the input
_FINER_BITS = 10  # cells that replace one next to a cut
_ROUNDS = 3
_APART = 1 << (64 - _BITS - _ROUNDS * _FINER_BITS)  # points of one finest cell
_SLICES = 1024  # slices of a shard in which slots are counted


def cuts_for(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Ends of the shards as indices into ``sizes``, for the smallest feasible capacity.

    A capacity is feasible when filling shards in order, each as far as it goes, needs no more
    than ``shards`` of them. Under it the shards are balanced, not filled.
    """
    reach = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])

    def ends(capacity: int) -> list[int] | None:
        at, cuts = 0, []
        while at < len(sizes) and len(cuts) <= shards:
            at = int(np.searchsorted(reach, reach[at] + capacity, side="right")) - 1
            cuts.append(at)
        return cuts if len(cuts) <= shards else None

    low = max(int(sizes.max(initial=0)), -(-int(reach[-1]) // shards))
    high = max(low, int(reach[-1]))
    while low < high:
        middle = (low + high) // 2
        if ends(middle) is None:
            low = middle + 1
        else:
            high = middle
    return _balanced(sizes, reach, shards, low)


def _above_share(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Indices of the sizes above an even share of what these leave to the other shards."""
    above = np.zeros(len(sizes), dtype=bool)
    while True:
        share = sizes[~above].sum() / (shards - above.sum())
        more = ~above & (sizes > share)
        if not more.any():
            return np.flatnonzero(above)
        above |= more


def _balanced(sizes: np.ndarray, reach: np.ndarray, shards: int, capacity: int) -> np.ndarray:
    """Ends of ``shards`` shards of nearly equal size, none above a feasible ``capacity``.

    Sizes above an even share get a shard each. A stretch between two of them is cut evenly into
    the number of shards that its size comes closest to; one of less than half a shard joins its
    neighbour where the capacity allows.
    """
    count, above = len(sizes), _above_share(sizes, shards)
    first = [count]  # by number of shards: where the rest that they can hold begins
    for _ in range(shards - 1):
        first.append(int(np.searchsorted(reach, reach[first[-1]] - capacity)))
    at, cuts = 0, []
    for left in range(shards, 0, -1):
        if at == count:
            cuts.append(count)
            continue
        full = int(np.searchsorted(reach, reach[at] + capacity, side="right")) - 1
        ahead = above[np.searchsorted(above, at):]
        stops = [*ahead[:2].tolist(), count, count]
        rest = reach[-1] - reach[at] - sizes[ahead].sum()
        share = rest / max(1, left - len(ahead))
        stretch = reach[stops[0]] - reach[at]
        if len(ahead) and 2 * stretch < share and (at == stops[0] or stops[0] < full):
            end = stops[0] + 1
            if 2 * (reach[stops[1]] - reach[end]) < share and stops[1] <= full:
                end = stops[1]
        else:
            behind = sum(start > stops[0] for start in first)  # shards needed from there on
            parts = min(round(stretch / share) if share else 1, left - behind)
            aim = reach[at] + stretch / max(1, parts)
            end = int(np.searchsorted(reach, aim))
            if end > at + 1 and aim - reach[end - 1] < reach[min(end, count)] - aim:
                end -= 1
        # the shards that are left must hold the rest, and have a size each if there are enough
        end = min(end, full, max(at + 1, count - left + 1))
        at = max(end, first[left - 1], at + 1)
        cuts.append(at)
    return np.array(cuts, dtype=np.int64)


def _cell_sums(sized: DataFrame, start: Column, depth: Column) -> DataFrame:
    return sized.groupBy(start.alias("start"), depth.alias("depth")).agg(
        F.sum("size").alias("size")
    )


def _cell(point: Column, bits: int) -> Column:
    """The first point of the cell that a point is in."""
    return F.shiftleft(F.shiftright(point, 64 - bits), 64 - bits)


def _large_first(sized: DataFrame, shards: int) -> DataFrame:
    """The rows with the points of groups above an even share moved to the start of the line."""
    cells = _cell_sums(sized, _cell(F.col("point"), _BITS), F.lit(_BITS)).toPandas()
    sizes = cells["size"].to_numpy(np.int64)
    heavy = _above_share(sizes, shards)
    if not len(heavy):
        return sized
    share = (sizes.sum() - sizes[heavy].sum()) / (shards - len(heavy))
    inside = _cell(F.col("point"), _BITS).isin([int(x) for x in cells["start"].iloc[heavy]])
    groups = sized.where(inside).groupBy("point").agg(F.sum("size").alias("size"))
    # fewer than shards groups can be above the share
    large = groups.where(F.col("size") > float(share)).orderBy(F.desc("size"), "point")
    point = F.col("point")
    for i, r in enumerate(large.limit(shards).collect()):
        point = F.when(F.col("point") == r.point, F.lit(i * _APART - 2**63)).otherwise(point)
    return sized.withColumn("point", point)


def _boundaries(sized: DataFrame, shards: int) -> list[int]:
    """First points of the shards after the first, in order; fewer if groups are fewer."""
    bits = _BITS
    cells = _cell_sums(sized, _cell(F.col("point"), bits), F.lit(bits)).toPandas()
    for level in range(_ROUNDS + 1):
        cells = cells.sort_values("start", ignore_index=True)
        starts, sizes = cells["start"].to_numpy(np.int64), cells["size"].to_numpy(np.int64)
        cuts = cuts_for(sizes, shards)[:-1]
        if level == _ROUNDS or not len(starts):
            break
        beside = {int(starts[c]) for cut in cuts for c in (cut - 1, cut) if 0 <= c < len(starts)}
        beside.add(int(starts[0]))  # large groups are told apart in the finest cells only
        coarse = cells[cells["start"].isin(beside) & (cells["depth"] == bits)]
        if coarse.empty:
            break
        # at most two cells per cut and the first are looked into: a list of fixed length
        inside = _cell(F.col("point"), bits).isin([int(x) for x in coarse["start"]])
        bits += _FINER_BITS
        finer = _cell_sums(sized.where(inside), _cell(F.col("point"), bits), F.lit(bits))
        rest = cells.drop(coarse.index)
        cells = type(cells)(
            {k: np.concatenate([rest[k], part]) for k, part in finer.toPandas().items()}
        )
    return [int(starts[cut]) for cut in cuts if cut < len(starts)]


def shard(
    docs: DataFrame, shards: int = 40, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Assign documents to ``shards`` shards of nearly equal bytes, equal texts together.

    Returns one row per row of ``docs``: ``doc_id, size`` (UTF-8 bytes of the text plus 16),
    ``text_crc32, shard`` from 0, ``slot`` (0, 1, ... within the shard). A null text counts as
    empty. A group larger than an even share makes its shard larger, never split; the other
    shards stay near equal. Rows that repeat an id are placed each for itself; a null id stays
    null. An empty table gives none.
    """
    text = whole(named(text_column))
    sized = materialise(
        docs.select(
            named(id_column).alias("doc_id"),
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("point"),
        ),
        "shard-sizes",
    )
    sized = _large_first(sized, shards)
    bounds = _boundaries(sized, shards)
    number = sum(((F.col("point") >= b).cast("int") for b in bounds), F.lit(0))
    placed = sized.withColumn("shard", number).withColumn(
        "slice", F.pmod(F.xxhash64("doc_id", "point"), F.lit(_SLICES)).cast("int")
    )
    # slots: rank within a small slice of the shard, plus the rows of the slices before it
    counts = placed.groupBy("shard", "slice").agg(F.count("*").alias("rows"))
    ahead = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("shard").alias("of_shard"), F.col("slice").alias("of_slice"),
        F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("base"),
    )
    rank = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("point", "doc_id"))
    # at most shards * slices rows
    return (
        placed.withColumn("rank", rank)
        .join(
            F.broadcast(materialise(offsets, "shard-offsets")),
            (F.col("shard") == F.col("of_shard")) & (F.col("slice") == F.col("of_slice")),
        )
        .select(
            "doc_id", "size", "text_crc32", "shard",
            (F.col("base") + F.col("rank") - 1).alias("slot"),
        )
    )
