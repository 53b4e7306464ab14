"""Report months and trailing metrics over sales cells."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.config import Config, check_month
from storeledger.functions.months import months_back
from storeledger.operators.cells import located
from storeledger.operators.skus import variant_groups


MOST_MONTHS = 1200  # a hundred years: each month is a column of the wide tables


def _months_of(cells: DataFrame) -> list[str]:
    months = cells.where(F.col("yyyymm").isNotNull()).select("yyyymm").distinct()
    found = sorted(row["yyyymm"] for row in months.limit(MOST_MONTHS + 1).collect())
    if len(found) > MOST_MONTHS:
        raise ValueError(f"sales of more than {MOST_MONTHS} months, from {found[0]}")
    return found


def month_list(cells: DataFrame) -> list[str]:
    """Months with sales, in order."""
    return _months_of(cells)


def sku_month_list(cells: DataFrame) -> list[str]:
    """Months with sales of a SKU at a location: the columns of the SKU tables."""
    return _months_of(located(cells).where(F.col("vendor_item").isNotNull()))


def latest_month(cells: DataFrame) -> DataFrame:
    return cells.agg(F.max("yyyymm").alias("report_month"))


@dataclass(frozen=True)
class Period:
    """Report month, its trailing windows and their divisors."""

    report_month: str
    last3: tuple[str, ...]
    last6: tuple[str, ...]
    n3: int
    n6: int


def period(months: Sequence[str], config: Config) -> Period:
    """Averages divide by the window months that occur anywhere in the data."""
    if config.report_month is None and not months:
        raise ValueError("no dated sales to take the report month from")
    report_month = check_month(config.report_month or max(months))
    last3, last6 = (tuple(months_back(report_month, n)) for n in (3, 6))
    n3, n6 = (max(len(set(window) & set(months)), 1) for window in (last3, last6))
    return Period(report_month, last3, last6, n3, n6)


def active_months(cells: DataFrame, report_month: str) -> DataFrame:
    """Divisors of the trailing averages as a one-row table."""
    window3, window6 = (months_back(report_month, n) for n in (3, 6))
    months = cells.where(F.col("yyyymm").isin(window6)).select("yyyymm").distinct()
    return months.agg(
        F.greatest(F.count_if(F.col("yyyymm").isin(window3)), F.lit(1)).alias("n3"),
        F.greatest(F.count("*"), F.lit(1)).alias("n6"),
    )


def active_month_list(cells: DataFrame, report_month: str, count: int = 6) -> DataFrame:
    """Window months that occur in the data."""
    return cells.where(in_months(months_back(report_month, count))).select("yyyymm").distinct()


def in_months(months: Sequence[str]) -> Column:
    return F.col("yyyymm").isin(*months)


def sum_in(months: Sequence[str], value: str) -> Column:
    return F.coalesce(F.sum(F.when(in_months(months), F.col(value))).cast("double"), F.lit(0.0))


def rolling_sales(cells: DataFrame, when: Period) -> DataFrame:
    """Last month and average monthly sales of every location, unrounded."""
    return located(cells).groupBy("location_code").agg(
        sum_in([when.report_month], "total").alias("last_month_total"),
        (sum_in(when.last3, "total") / when.n3).alias("avg_monthly_3m"),
        (sum_in(when.last6, "total") / when.n6).alias("avg_monthly_6m"),
    )


def rolling_qty(cells: DataFrame, when: Period) -> DataFrame:
    """Quantities of every (location, SKU) sold in the last three months."""
    return (
        located(cells)
        .where(F.col("vendor_item").isNotNull() & in_months(when.last6))
        .groupBy("location_code", "vendor_item")
        .agg(
            F.count_if(in_months(when.last3)).alias("cells_3m"),
            sum_in(when.last3, "qty").alias("qty_3m_total"),
            sum_in([when.report_month], "qty").alias("last_month_qty"),
            (sum_in(when.last3, "qty") / when.n3).alias("avg_qty_3m"),
            (sum_in(when.last6, "qty") / when.n6).alias("avg_qty_6m"),
        )
        .where("cells_3m > 0")
        .drop("cells_3m")
    )


def sku_group_qty(cells: DataFrame, when: Period, config: Config) -> DataFrame:
    """Three-month quantity per (location, SKU group)."""
    recent = located(cells).where(F.col("vendor_item").isNotNull() & in_months(when.last3))
    return (
        variant_groups(recent, config)
        .groupBy("location_code", "sku_group", "sku_display")
        .agg(F.sum("qty").cast("double").alias("qty_3m"))
    )


def most_popular_sku(group_qty: DataFrame) -> DataFrame:
    """Group with the largest quantity, the smallest key among equals."""
    best = F.min(F.struct((-F.col("qty_3m")).alias("order"), "sku_group", "sku_display"))
    return group_qty.groupBy("location_code").agg(best["sku_display"].alias("most_popular_sku"))


def last_columns(months: Sequence[str]) -> list[str]:
    return sorted(months)[-3:]


def sku_sales_3m(cells: DataFrame, months: Sequence[str]) -> DataFrame:
    """Average sales per (location, SKU) over the last three of ``months``, the
    columns of the SKU tables, whatever the report month is."""
    last = last_columns(months)
    return (
        located(cells)
        .where(F.col("vendor_item").isNotNull() & F.col("yyyymm").isNotNull())
        .groupBy("location_code", "vendor_item")
        .agg((sum_in(last, "total") / max(len(last), 1)).alias("avg_sales_3m"))
    )

