"""The report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeledger.config import Config
from storeledger.functions.numbers import round_half_even
from storeledger.functions.tiers import sla_tier, visit_frequency
from storeledger.operators.cells import located
from storeledger.operators.locations import enrich
from storeledger.operators.metrics import Period, in_months, rolling_qty
from storeledger.operators.skus import variant_groups


def _dated(cells: DataFrame) -> DataFrame:
    return located(cells).where(F.col("yyyymm").isNotNull())


def sales_by_location_month_long(cells: DataFrame) -> DataFrame:
    return _dated(cells).groupBy("location_code", "yyyymm").agg(F.sum("total").alias("total"))


def by_sku_location_month_long(cells: DataFrame) -> DataFrame:
    """Sales and quantity in one pass."""
    return (
        _dated(cells)
        .where(F.col("vendor_item").isNotNull())
        .groupBy("location_code", "vendor_item", "yyyymm")
        .agg(F.sum("total").alias("total"), F.sum("qty").alias("qty"))
    )


def _month_columns(rows: DataFrame, meta: Sequence[str], months: Sequence[str]) -> DataFrame:
    """``meta`` and a column per month, 0 where a key has no sales, from the map ``values``.

    The map is brought into the order of the months first, and the columns take their places
    from that. A search of the map in every column makes one method of the whole table, too long
    for the JVM to compile.
    """
    def value(month: Column) -> Column:
        return F.coalesce(F.try_element_at("values", month).cast("double"), F.lit(0.0))

    in_order = F.transform(F.array(*map(F.lit, months)), value)
    return rows.select(*meta, in_order.alias("in_order")).select(
        *meta, *[F.get("in_order", F.lit(at)).alias(month) for at, month in enumerate(months)]
    )


def _by_month(long: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys, values``: a map by month, from rows that are one per key and month."""
    entry = F.struct("yyyymm", F.col(value))
    return long.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("values"))


def sku_month_sums(cells: DataFrame, value: str) -> DataFrame:
    """``location_code, vendor_item, yyyymm`` and the sum of a measure, dealt out by SKU and
    location.

    Cells are sums already, so combining them again before a shuffle would find little. Dealt
    out once, the sums per month and what is gathered from them need no further shuffle.
    """
    keys = ["location_code", "vendor_item"]
    dealt = (
        _dated(cells).where(F.col("vendor_item").isNotNull())
        .select(*keys, "yyyymm", value).repartition(*keys)
    )
    return dealt.groupBy(*keys, "yyyymm").agg(F.sum(value).alias(value))


def wide_by_location(
    long: DataFrame, location_map: DataFrame, months: Sequence[str]
) -> DataFrame:
    """A row per location with a column per month, from sums per location and month."""
    meta = ("location_code", "customer_name", "chain", "crm_customer_id", "crm_customer_name")
    named = enrich(_by_month(long, ["location_code"], "total"), location_map)
    return _month_columns(named, meta, months)


def wide_by_sku_location(
    long: DataFrame,
    descriptions: DataFrame,
    location_map: DataFrame,
    months: Sequence[str],
    value: str,
) -> DataFrame:
    """A row per SKU and location with a column per month. The columns are made behind the
    joins, so what is shuffled holds the months a SKU was sold in, not all of them."""
    values = _by_month(long, ["location_code", "vendor_item"], value)
    described = values.join(descriptions, "vendor_item", "left")
    meta = ("location_code", "chain", "crm_customer_id", "vendor_item", "item_description")
    return _month_columns(enrich(described, location_map), meta, months)


def sales_by_location_month(
    cells: DataFrame, location_map: DataFrame, months: Sequence[str]
) -> DataFrame:
    """A location may hold much of the data: its sales are summed per month before they are
    shuffled, and what is gathered per location has one entry a month."""
    return wide_by_location(sales_by_location_month_long(cells), location_map, months)


def sales_by_sku_location_month(
    cells: DataFrame, descriptions: DataFrame, location_map: DataFrame, months: Sequence[str]
) -> DataFrame:
    sums = sku_month_sums(cells, "total")
    return wide_by_sku_location(sums, descriptions, location_map, months, "total")


def qty_by_sku_location_month(
    cells: DataFrame, descriptions: DataFrame, location_map: DataFrame, months: Sequence[str]
) -> DataFrame:
    sums = sku_month_sums(cells, "qty")
    return wide_by_sku_location(sums, descriptions, location_map, months, "qty")


def snapshot_metrics(cells: DataFrame, when: Period, config: Config) -> DataFrame:
    """Snapshot values of every location, unrounded.

    Sums per (location, SKU group) come first and give both the most popular
    group and, added up, the sales of the location, so no metric is joined.
    Only the last three months are summed per group: the cells of all others are
    combined to one row per location before they are shuffled.
    """
    recent = in_months(when.last3) & F.col("vendor_item").isNotNull()
    told_apart = located(cells).withColumn("vendor_item", F.when(recent, F.col("vendor_item")))
    groups = (
        variant_groups(told_apart, config)
        .groupBy("location_code", "sku_group", "sku_display")
        .agg(
            *[
                F.sum(F.when(in_months(months), F.col("total"))).alias(name)
                for name, months in (
                    ("last", [when.report_month]), ("last3", when.last3), ("last6", when.last6),
                )
            ],
            F.sum(F.when(recent, F.col("qty"))).alias("qty_3m"),
        )
    )
    best = F.min(
        F.when(
            F.col("qty_3m").isNotNull(),
            F.struct((-F.col("qty_3m")).alias("order"), "sku_group", "sku_display"),
        )
    )

    def summed(name: str):
        return F.coalesce(F.sum(name).cast("double"), F.lit(0.0))

    return groups.groupBy("location_code").agg(
        summed("last").alias("last_month_total"),
        (summed("last3") / when.n3).alias("avg_monthly_3m"),
        (summed("last6") / when.n6).alias("avg_monthly_6m"),
        best["sku_display"].alias("most_popular_sku"),
    )


def location_snapshot(
    cells: DataFrame, location_map: DataFrame, when: Period, config: Config
) -> DataFrame:
    """One row per location, with zeros for locations without recent sales."""
    tier = sla_tier(F.col("avg_monthly_3m"), config)
    metrics = snapshot_metrics(cells, when, config).withColumn("sla_tier", tier)
    return enrich(metrics, location_map).select(
        "location_code", "customer_name", "chain", "crm_customer_id", "crm_customer_name",
        *[
            round_half_even(F.col(name), 2).alias(name)
            for name in ("last_month_total", "avg_monthly_3m", "avg_monthly_6m")
        ],
        "sla_tier",
        visit_frequency(F.col("sla_tier"), config).alias("visit_frequency"),
        "most_popular_sku",
        F.lit(when.report_month).alias("report_month"),
    )


def ranked_skus(cells: DataFrame, when: Period, config: Config) -> DataFrame:
    """The ``top_n`` SKUs of each location by three-month quantity."""
    order = Window.partitionBy("location_code").orderBy(
        F.col("qty_3m_total").desc(), F.col("vendor_item")
    )
    return (
        rolling_qty(cells, when)
        .withColumn("sku_rank", F.row_number().over(order))
        .where(F.col("sku_rank") <= config.top_n)
    )


def top_skus(
    cells: DataFrame,
    descriptions: DataFrame,
    location_map: DataFrame,
    when: Period,
    config: Config,
) -> DataFrame:
    top = ranked_skus(cells, when, config).join(descriptions, "vendor_item", "left")
    return enrich(top, location_map).select(
        "location_code", "chain", "crm_customer_id", "vendor_item", "item_description",
        "last_month_qty",
        round_half_even(F.col("avg_qty_3m"), 1).alias("avg_qty_3m"),
        round_half_even(F.col("avg_qty_6m"), 1).alias("avg_qty_6m"),
        F.lit(when.report_month).alias("report_month"),
        "sku_rank",
    )
