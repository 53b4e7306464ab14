"""Run profile, coverage and reconciliation tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.config import AMOUNT, DISTRIBUTOR, SOURCES
from storeledger.operators.cells import Audit, located
from storeledger.operators.matching import is_mapped
from storeledger.operators.unify import precedence_dedup, source_rank
from storeledger.staging import materialise


def dedup_audit(audit: Audit, spark: SparkSession) -> DataFrame:
    """Distributor rows before and after the dedup, as noted while a run wrote its cells."""
    before, after = audit.before[DISTRIBUTOR], audit.after[DISTRIBUTOR]
    return spark.createDataFrame(
        [(before, after, before - after)], "rows_before long, rows_after long, rows_removed long"
    )


def observed_profile(audit: Audit, cells: DataFrame) -> DataFrame:
    """``run_profile`` from what was noted; only the locations are counted, in one column."""
    noted = audit.after
    return distinct_locations(cells).agg(F.count("*").alias("locations")).select(
        F.lit(noted["lines"]).cast("long").alias("transactions"),
        F.lit(noted["unlocated"]).cast("long").alias("rows_without_location"), "locations",
        F.lit(noted["first_month"]).cast("string").alias("first_month"),
        F.lit(noted["last_month"]).cast("string").alias("last_month"),
        *[F.lit(noted[name]).cast("long").alias(f"{name}_rows") for name in SOURCES],
    )


def run_profile(cells: DataFrame) -> DataFrame:
    """Sales, locations, month range and sales per source, from sales cells."""
    lines = F.coalesce(F.sum("lines"), F.lit(0))
    per_source = [
        F.coalesce(F.sum(F.when(F.col("source") == name, F.col("lines"))), F.lit(0)).alias(
            f"{name}_rows"
        )
        for name in SOURCES
    ]
    no_location = F.sum(F.when(F.col("location_code").isNull(), F.col("lines")))
    return cells.agg(
        lines.alias("transactions"),
        F.coalesce(no_location, F.lit(0)).alias("rows_without_location"),
        F.countDistinct("location_code").alias("locations"),
        F.min("yyyymm").alias("first_month"),
        F.max("yyyymm").alias("last_month"),
        *per_source,
    )


def distinct_locations(cells: DataFrame) -> DataFrame:
    return located(cells).select("location_code").distinct()


def tier_distribution(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy("sla_tier").agg(F.count("*").alias("locations"))


def mapping_coverage(location_map: DataFrame) -> DataFrame:
    return location_map.agg(
        F.count("*").alias("locations"),
        F.count_if(is_mapped()).alias("mapped"),
        F.count_if(~is_mapped()).alias("unmapped"),
    )


def reconcile_invoices(sales: DataFrame) -> DataFrame:
    """Invoices that more than one source reports, before and after the dedup."""
    invoices = materialise(
        sales.where(F.col("location_code").isNotNull() & F.col("invoice_num").isNotNull())
        .select("source", "location_code", "invoice_num")
        .distinct(),
        "invoices",
    )

    def shared(lines: DataFrame, name: str) -> DataFrame:
        ranks = lines.groupBy("invoice_num").agg(
            F.min(source_rank()).alias("lo"), F.max(source_rank()).alias("hi")
        )
        return ranks.agg(
            F.lit(name).alias("stage"),
            F.count("*").alias("invoices"),
            F.count_if(F.col("lo") != F.col("hi")).alias("in_two_sources"),
        )

    return shared(invoices, "before").unionByName(shared(precedence_dedup(invoices), "after"))


BY_LOCATION, BY_SKU = "location", "sku and location"
MEASURES = {"sales": "total", "quantity": "qty"}


def reconcile_totals(
    view: DataFrame, expected: DataFrame, tolerance: float = 0.005
) -> DataFrame:
    """Compare sales and quantities of a run with independent ones, at two grains.

    Both frames have ``location_code, vendor_item, yyyymm, total, qty``, at any finer grain:
    sums of a run, and single lines or other sums. Both are added up per location and month and
    per SKU, location and month in one aggregation, so no key of either side meets the other in
    a join. Rows without location or month are in no report; rows without a SKU are in those by
    location only. Without ``vendor_item``, ``total`` or ``qty`` on both sides that grain or
    measure is left out.

    Rows are dealt out once, by location and month, and take part in both grains there. Sums
    of a run are one row per key already, so combining them before the shuffle finds little, and
    there a row would be a row per grain.

    One row per grain, key and measure: ``grain, location_code, vendor_item, yyyymm, measure,
    view_value, expected_value, status``, keys that only one side has included.
    """
    shared = set(view.columns) & set(expected.columns)
    measures = {name: column for name, column in MEASURES.items() if column in shared}
    by_sku = "vendor_item" in shared
    sku = F.col("vendor_item") if by_sku else F.lit(None).cast("string").alias("vendor_item")
    keys = ["location_code", "vendor_item", "yyyymm"]
    sides = {"view": view, "expected": expected}

    both = reduce(DataFrame.unionByName, [
        df.select(
            "location_code", sku, "yyyymm", F.lit(side == "view").alias("in_view"),
            *[F.col(column).cast(AMOUNT).alias(column) for column in measures.values()],
        )
        for side, df in sides.items()
    ]).where(F.col("location_code").isNotNull() & F.col("yyyymm").isNotNull())
    # a row counts in its location, and in its SKU there if it names one
    in_location = F.struct(
        F.lit(False).alias("of_sku"), F.lit(None).cast("string").alias("vendor_item")
    )
    in_sku = F.struct(F.lit(True).alias("of_sku"), "vendor_item")
    parts = F.when(F.col("vendor_item").isNull(), F.array(in_location)).otherwise(
        F.array(in_location, in_sku)
    )
    dealt = both.repartition("location_code", "yyyymm").select(
        "location_code", "yyyymm", "in_view", *measures.values(), F.inline(parts)
    )
    of_side = {"view": F.col("in_view"), "expected": ~F.col("in_view")}
    compared = dealt.groupBy("of_sku", *keys).agg(
        *[F.count_if(of_side[side]).alias(f"{side}_rows") for side in sides],
        *[F.sum(F.when(of_side[side], F.col(column))).alias(f"{side}_{column}")
          for side in sides for column in measures.values()],
    )
    values = F.array(*[
        F.struct(
            F.lit(name).alias("measure"), F.col(f"view_{column}").alias("view_value"),
            F.col(f"expected_{column}").alias("expected_value"),
        )
        for name, column in measures.items()
    ])
    zero = F.lit(0).cast(AMOUNT)
    gap = F.abs(F.coalesce("view_value", zero) - F.coalesce("expected_value", zero))
    status = (
        F.when(F.col("expected_rows") == 0, "not expected")
        .when(F.col("view_rows") == 0, "missing")
        .when(gap <= tolerance, "equal")
        .otherwise("different")
    )
    grain = F.when(F.col("of_sku"), BY_SKU).otherwise(BY_LOCATION).alias("grain")
    return (
        compared.select(grain, *keys, "view_rows", "expected_rows", F.inline(values))
        .select("grain", *keys, "measure", "view_value", "expected_value",
                status.alias("status"))
    )


def reconciliation_summary(compared: DataFrame) -> DataFrame:
    """Keys and values of each grain and measure by status."""
    return compared.groupBy("grain", "measure", "status").agg(
        F.count("*").alias("keys"), F.sum("view_value").alias("view_value"),
        F.sum("expected_value").alias("expected_value"),
    )
