"""Union of the sources and removal of sales reported twice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.config import AUTHORITATIVE, SOURCES
from storeledger.staging import materialise


def unify(*sources: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def chain_codes(sales: DataFrame) -> DataFrame:
    """Locations reported by any authoritative source."""
    chains = sales.where(F.col("source").isin(*AUTHORITATIVE))
    return chains.where(F.col("location_code").isNotNull()).select("location_code").distinct()


def precedence_dedup(sales: DataFrame, chains: DataFrame | None = None) -> DataFrame:
    """Drop distributor rows of locations that an authoritative source reports.

    ``sales`` is any frame with ``source`` and ``location_code``: single sales
    or sums of them. The codes come from ``chains``, any frame that holds the
    authoritative sales, or else from ``sales``. Of a union of sources, only the
    authoritative ones are read for them, and of those two columns.

    The codes are written first, so that their size is known and the wide side
    is not shuffled when they are few. When they are many, the sort-merge anti
    join splits a hot location at run time.
    """
    return drop_reported_twice(sales, written_codes(sales if chains is None else chains))


def written_codes(chains: DataFrame) -> DataFrame:
    return materialise(chain_codes(chains), "chain-codes")


def drop_reported_twice(sales: DataFrame, codes: DataFrame) -> DataFrame:
    """``precedence_dedup`` with codes that are written already."""
    codes = codes.withColumnRenamed("location_code", "chain_code")
    reported_twice = ~F.col("source").isin(*AUTHORITATIVE) & (
        F.col("location_code") == F.col("chain_code")
    )
    return sales.join(codes, reported_twice, "left_anti")


def unified(sales: DataFrame) -> DataFrame:
    """Single sales without those reported twice, from one scan of the sources.

    The tagged sales are written once. The chains' codes are read from what was written, two
    columns of the chains' rows, and then filter it.
    """
    return precedence_dedup(materialise(sales, "tagged"))


def source_rank() -> Column:
    """Position of a row's source in the union order, from 1."""
    return F.array_position(F.array(*map(F.lit, SOURCES)), F.col("source")).cast("int")


def dedup_audit(sales: DataFrame) -> DataFrame:
    """Distributor rows before and after the dedup, in one pass over the sales."""
    lines = F.col("lines")
    per_location = sales.groupBy("location_code").agg(
        F.count_if(~F.col("source").isin(*AUTHORITATIVE)).alias("lines"),
        F.count_if(F.col("source").isin(*AUTHORITATIVE)).alias("chain_lines"),
    )
    twice = (F.col("chain_lines") > 0) & F.col("location_code").isNotNull()
    removed = F.coalesce(F.sum(F.when(twice, lines)), F.lit(0))
    total = F.coalesce(F.sum(lines), F.lit(0))
    return per_location.agg(
        total.alias("rows_before"),
        (total - removed).alias("rows_after"),
        removed.alias("rows_removed"),
    )
