"""Sales cells: sums of the sales at the grain the reports need.

Whether a sale counts depends on its source and location only, so sales are
summed first and deduplicated afterwards. The fact table is read once, its
rows are combined before the only shuffle, and every report reads the cells.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from storeledger.config import SOURCES
from storeledger.operators.unify import drop_reported_twice, precedence_dedup, written_codes
from storeledger.staging import materialise

PLACE = ("customer_name", "address", "city", "state", "zip")
LOCATION_GRAIN = ("source", "location_code", "yyyymm")
SKU_GRAIN = ("source", "location_code", "vendor_item", "item_description", "yyyymm")
LOCATION_PLACE_GRAIN = (*LOCATION_GRAIN, *PLACE)
FULL_GRAIN = (*SKU_GRAIN, *PLACE)
MEASURES = ("total", "qty")


def _sums(measures: Sequence[str]) -> list[Column]:
    return [*[F.sum(name).alias(name) for name in measures], F.count("*").alias("lines")]


def sum_cells(
    sales: DataFrame, grain: Sequence[str], measures: Sequence[str] = MEASURES
) -> DataFrame:
    return sales.groupBy(*grain).agg(*_sums(measures))


def located(cells: DataFrame) -> DataFrame:
    """Rows that name a location; the others are counted but not reported."""
    return cells.where(F.col("location_code").isNotNull())


@dataclass(frozen=True)
class Audit:
    """Counts noted while cells were written: lines of sales in all, per source and without
    location, first and last month, before and after the dedup."""

    before: dict
    after: dict


def _noted(grain: Sequence[str], counted: str = "true") -> list[Column]:
    def lines(condition: Column, name: str) -> Column:
        found = F.sum(F.when(F.expr(counted) & condition, F.col("lines")))
        return F.coalesce(found, F.lit(0)).alias(name)

    found = [lines(F.lit(True), "lines"), lines(F.col("location_code").isNull(), "unlocated")]
    found += [lines(F.col("source") == name, name) for name in SOURCES]
    months = F.col("yyyymm") if "yyyymm" in grain else F.lit(None).cast("string")
    return [*found, F.min(months).alias("first_month"), F.max(months).alias("last_month")]


def observed_cells(
    sales: DataFrame, grain: Sequence[str] = FULL_GRAIN, measures: Sequence[str] = MEASURES
) -> tuple[DataFrame, Audit]:
    """Deduplicated cells of a tagged union of sources, written once, and their audit.

    The sums are written first, and the chains' location codes are taken from
    them: the sales themselves are read once. Written, the cells carry no
    partitioning by location from the dedup, so that later sums combine a hot
    location in many tasks before they shuffle it. The audit is observed in the
    tasks that write, so it costs no scan.
    """
    before, after = Observation("before-dedup"), Observation("after-dedup")
    sums = sum_cells(sales, grain, measures)
    summed = materialise(sums.observe(before, *_noted(grain)), "summed")
    cells = materialise(precedence_dedup(summed).observe(after, *_noted(grain)), "cells")
    return cells, Audit(before.get, after.get)


def cells_and_places(
    sales: DataFrame, grain: Sequence[str] = FULL_GRAIN, measures: Sequence[str] = MEASURES
) -> tuple[DataFrame, DataFrame, Audit]:
    """Deduplicated cells of ``grain`` without the places, the lines of each location's places,
    and the audit.

    The places of a location are needed once, for its reference row, and no sum depends on them.
    Grouping sets sum the cells and count the places side by side, in one scan and one shuffle:
    a cell is not repeated for every way a location's address is written, and carries none of it.
    """
    keys = [name for name in grain if name not in PLACE]
    spots = ["source", "location_code", *PLACE]
    columns = list(dict.fromkeys([*keys, *spots]))
    both = sales.groupingSets([keys, spots], *columns).agg(
        F.grouping("yyyymm").cast("int").alias("of_place"), *_sums(measures)
    )
    before, after = Observation("before-dedup"), Observation("after-dedup")
    summed = materialise(both.observe(before, *_noted(grain, "of_place = 0")), "summed")
    spot_lines = summed.where("of_place = 1").select(*spots, "lines")
    cells = summed.where("of_place = 0").select(*keys, *measures, "lines")
    codes = written_codes(spot_lines)
    kept = drop_reported_twice(cells, codes).observe(after, *_noted(grain))
    cells = materialise(kept, "cells")
    return cells, drop_reported_twice(spot_lines, codes), Audit(before.get, after.get)


def sales_cells(sales: DataFrame, grain: Sequence[str] = FULL_GRAIN) -> DataFrame:
    """Deduplicated cells alone."""
    return observed_cells(sales, grain)[0]


def cells_read_once(sales: DataFrame, grain: Sequence[str] = FULL_GRAIN) -> DataFrame:
    """Deduplicated cells alone, for a single reader: the sums are written, as the chains' codes
    come from them, and the dedup is done where the cells are read."""
    return precedence_dedup(materialise(sum_cells(sales, grain), "summed"))
