"""Resolve report targets and gather what their forms show."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storeledger.config import Config
from storeledger.functions.numbers import fmt_money, fmt_qty
from storeledger.staging import lookup, materialise

LOCATION, CUSTOMER = "location", "customer"
SNAPSHOT_VALUES = ("report_month", "last_month_total")


def resolve_targets(targets: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Targets with the snapshot row of their location, else of their customer.

    ``key_kind`` and ``key`` say which; both are null for an unknown target. Of
    several locations with one customer id the last location code counts.
    """
    row = F.struct("location_code", *SNAPSHOT_VALUES)
    snapshot = materialise(snapshot, "snapshot")
    by_location = snapshot.select("location_code", row.alias("loc_row"))
    by_customer = (
        snapshot.where(F.btrim("crm_customer_id") != "")
        .groupBy("crm_customer_id")
        .agg(F.max_by(row, "location_code").alias("id_row"))
    )
    found = lookup(
        targets.join(by_location, "location_code", "left"), by_customer, "crm_customer_id"
    )
    chosen = F.coalesce("loc_row", "id_row")
    kind = F.when(F.col("loc_row").isNotNull(), LOCATION).when(
        F.col("id_row").isNotNull(), CUSTOMER
    )
    return found.select(
        *targets.columns,
        kind.alias("key_kind"),
        F.when(kind == LOCATION, F.col("location_code"))
        .when(kind == CUSTOMER, F.col("crm_customer_id"))
        .alias("key"),
        *[chosen[name].alias(name) for name in SNAPSHOT_VALUES],
    )


def unresolved_targets(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col("key_kind").isNull()).drop(
        "key_kind", "key", *SNAPSHOT_VALUES
    )


def sku_keys(top_skus: DataFrame) -> DataFrame:
    """Top SKU rows once under their location and once under their customer."""
    mapped = F.btrim("crm_customer_id") != ""
    keys = F.array_compact(
        F.array(
            F.struct(F.lit(LOCATION).alias("key_kind"), F.col("location_code").alias("key")),
            F.when(
                mapped,
                F.struct(F.lit(CUSTOMER).alias("key_kind"), F.col("crm_customer_id").alias("key")),
            ),
        )
    )
    return top_skus.select("*", F.inline(keys))


def key_units(top_skus: DataFrame) -> DataFrame:
    """Last-month units of all top SKU rows of a key, cut to an integer."""
    return (
        sku_keys(top_skus)
        .groupBy("key_kind", "key")
        .agg(
            F.sum(F.col("last_month_qty").cast("decimal(28,8)")).cast("bigint").alias("total_units"),
            F.count("*").alias("sku_rows"),
        )
    )


def key_skus(top_skus: DataFrame, top_n: int) -> DataFrame:
    """First ``top_n`` SKU rows of a key, by location and rank.

    The rows of a customer are cut before targets join them: many targets of a
    customer with many locations get ``top_n`` rows each, not all pairs.
    """
    order = Window.partitionBy("key_kind", "key").orderBy(
        F.col("location_code"), F.col("sku_rank")
    )
    return (
        sku_keys(top_skus)
        .withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= top_n)
        .select(
            "key_kind", "key", "position", "vendor_item", "last_month_qty", "avg_qty_3m"
        )
    )


def target_units(resolved: DataFrame, top_skus: DataFrame) -> DataFrame:
    known = resolved.where(F.col("key_kind").isNotNull())
    return lookup(known, key_units(top_skus), ["key_kind", "key"]).fillna(
        {"total_units": 0, "sku_rows": 0}
    )


def target_skus(resolved: DataFrame, top_skus: DataFrame, config: Config) -> DataFrame:
    """SKU rows each target's form lists, with their position."""
    wanted = resolved.where(F.col("key_kind").isNotNull()).select(
        "target_ord", "target_id", "location_code", "key_kind", "key"
    )
    rows = materialise(key_skus(top_skus, config.top_n), "key-skus")
    return wanted.join(rows, ["key_kind", "key"])


def with_sku_sales(listed: DataFrame, sku_sales: DataFrame) -> DataFrame:
    """Add average SKU sales by the target's own location code, else 0.

    Only sales of locations that targets name are summed up and written.
    """
    listed = materialise(listed, "listed-skus")
    named = listed.where(F.col("location_code").isNotNull()).select("location_code").distinct()
    sales = sku_sales.join(named, "location_code", "left_semi").select(
        "location_code", "vendor_item", "avg_sales_3m"
    )
    return lookup(listed, sales, ["location_code", "vendor_item"]).withColumn(
        "avg_sales_3m", F.coalesce("avg_sales_3m", F.lit(0.0))
    )


def sku_lines(listed: DataFrame) -> DataFrame:
    """Display line of each listed SKU."""
    shown_qty = F.coalesce("avg_qty_3m", "last_month_qty", F.lit(0.0))
    line = F.concat_ws(
        " | ",
        F.col("vendor_item"),
        fmt_money(F.col("avg_sales_3m")),
        F.concat(fmt_qty(shown_qty), F.lit(" units/mo")),
    )
    return listed.select("target_ord", "target_id", "position", line.alias("line"))
