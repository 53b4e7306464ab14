"""SKU descriptions, variant groups and aliases."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.config import Config
from storeledger.functions.text import norm_key, norm_key_text
from storeledger.staging import lookup


def canonical_description(sales: DataFrame) -> DataFrame:
    """Longest description per SKU, the smallest text among equals.

    A missing description competes with the length of the text ``nan``.
    """
    variants = (
        sales.where(F.col("vendor_item").isNotNull())
        .select("vendor_item", "item_description")
        .distinct()
    )
    text = F.coalesce("item_description", F.lit("nan"))
    longest_first = F.struct(
        (-F.length(text)).alias("order"), text.alias("text"), F.col("item_description")
    )
    return variants.groupBy("vendor_item").agg(
        F.min(longest_first)["item_description"].alias("item_description")
    )


class Variant(NamedTuple):
    """A SKU key, the key of the group it counts in, and the text shown for that group."""

    sku: str
    group: str
    shown: str


def variant_table(config: Config) -> list[Variant]:
    """One row per SKU listed in a group, and one per group for its own name.

    A group shows its first listed SKU, one without a list its name. A value that
    is no list lists nothing.
    """
    listed = {
        group: tuple(skus) if isinstance(skus, list | tuple) else ()
        for group, skus in config.sku_variant_groups.items()
    }
    return [
        Variant(norm_key_text(sku), norm_key_text(group), next(iter(skus), group))
        for group, skus in listed.items()
        for sku in (*skus, group)
    ]


def variant_groups(df: DataFrame, config: Config) -> DataFrame:
    """Add ``sku_group``, the key of a SKU's variant group or the SKU's own key,
    and ``sku_display``, the text shown for that group. Of groups that list the
    same SKU the last one counts."""
    own = norm_key(F.col("vendor_item"))
    table = variant_table(config)
    if not table:
        return df.withColumn("sku_group", own).withColumn("sku_display", own)
    groups = _literal_map({row.sku: row.group for row in table})
    shown = _literal_map({row.group: row.shown for row in table})
    return df.withColumn(
        "sku_group", F.coalesce(F.try_element_at(groups, own), own)
    ).withColumn(
        "sku_display", F.coalesce(F.try_element_at(shown, F.col("sku_group")), F.col("sku_group"))
    )


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.map_from_arrays(
        F.array(*map(F.lit, pairs)), F.array(*map(F.lit, pairs.values()))
    )


def apply_sku_aliases(sales: DataFrame, aliases: DataFrame) -> DataFrame:
    """Replace SKUs named in ``aliases`` (excel_sku, mapped_sku)."""
    one_each = (
        aliases.where(F.col("excel_sku").isNotNull())
        .groupBy(F.col("excel_sku").alias("vendor_item"))
        .agg(F.min("mapped_sku").alias("mapped_sku"))
    )
    return (
        lookup(sales, one_each, "vendor_item")
        .withColumn("vendor_item", F.coalesce("mapped_sku", "vendor_item"))
        .select(*sales.columns)
    )

