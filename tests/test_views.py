from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from storeledger.config import Config
from storeledger.operators import metrics, quality, skus, unify
from storeledger.operators.skus import variant_groups
from storeledger.operators.cells import FULL_GRAIN, observed_cells, sales_cells, sum_cells
from storeledger.plans import views
from tests.conftest import rows


@pytest.fixture
def cells(spark):
    def make(*sales):
        """(location, SKU, description, month, total, qty)"""
        data = [("distributor", *s, "n", "a", "c", "s", "z") for s in sales]
        df = spark.createDataFrame(
            [(r[0], r[1], r[2], r[3], r[4], float(r[5]), float(r[6]), *r[7:]) for r in data],
            "source string, location_code string, vendor_item string, item_description string,"
            " yyyymm string, total double, qty double, customer_name string, address string,"
            " city string, state string, zip string",
        )
        amounts = df.withColumns(
            {n: F.col(n).cast("decimal(28,8)") for n in ("total", "qty")}
        )
        return sum_cells(amounts, FULL_GRAIN)

    return make


@pytest.fixture
def one_map(frame):
    return frame(
        "location_code, customer_name, chain, crm_customer_id, crm_customer_name",
        [("A", "Ann", "distributor", "1", "Ann Inc")],
    )


def period(cells, month="2025-10"):
    return metrics.period(metrics.month_list(cells), Config(report_month=month))


def test_divisor_is_months_with_data_anywhere(cells):
    data = cells(("A", "1", "d", "2025-10", 30, 3), ("B", "1", "d", "2025-08", 60, 6),
                 ("A", "1", "d", "2025-05", 40, 4), ("A", "1", "d", "2025-04", 999, 9))
    when = period(data)  # September has no sales at all, nor June and July
    assert (when.n3, when.n6) == (2, 3)
    assert tuple(metrics.active_months(data, "2025-10").first()) == (2, 3)
    assert rows(metrics.active_month_list(data, "2025-10")) == [
        ("2025-05",), ("2025-08",), ("2025-10",)]
    assert rows(metrics.rolling_sales(data, when)) == [
        ("A", 30.0, 15.0, 70 / 3), ("B", 0.0, 30.0, 20.0)]


def test_divisor_is_at_least_one(cells):
    data = cells(("A", "1", "d", "2020-01", 30, 3))
    when = period(data)
    assert (when.n3, when.n6) == (1, 1)
    assert tuple(metrics.active_months(data, "2025-10").first()) == (1, 1)


def test_report_month_is_the_latest_unless_given(cells):
    data = cells(("A", "1", "d", "2025-10", 1, 1), ("A", "1", "d", None, 1, 1),
                 ("A", "1", "d", "2025-09", 1, 1))
    assert metrics.latest_month(data).first()[0] == "2025-10"
    assert metrics.period(metrics.month_list(data), Config()).report_month == "2025-10"
    with pytest.raises(ValueError):
        metrics.period([], Config())


def test_snapshot(cells, one_map):
    data = cells(("A", "s1", "d", "2025-10", 849.996, 2), ("A", "s2", "d", "2025-10", 0, 2),
                 ("B", "s1", "d", None, 5, 5), ("C", None, None, "2025-10", 850, 99),
                 (None, "s1", "d", "2025-10", 7, 7))
    snapshot = views.location_snapshot(data, one_map, period(data), Config())
    assert rows(snapshot) == [
        ("A", "Ann", "distributor", "1", "Ann Inc", 850.0, 850.0, 850.0, "Tier 2", "Bi-Monthly",
         "S1", "2025-10"),
        ("B", None, None, None, None, 0.0, 0.0, 0.0, "Tier 4", "Annually", None, "2025-10"),
        ("C", None, None, None, None, 850.0, 850.0, 850.0, "Tier 1", "Monthly", None, "2025-10"),
    ]
    assert rows(quality.tier_distribution(snapshot)) == [
        ("Tier 1", 1), ("Tier 2", 1), ("Tier 4", 1)]


def test_group_without_a_list_stands_for_itself(frame):
    df = frame("vendor_item", [("E69",), ("E",), ("E69 5",)])
    grouped = variant_groups(df, Config(sku_variant_groups={"E69": "E69 5"}))
    assert rows(grouped, "vendor_item", "sku_group", "sku_display") == [
        ("E", "E", "E"), ("E69 5", "E69 5", "E69 5"), ("E69", "E69", "E69")]


def test_last_group_that_lists_a_sku_counts(frame):
    config = Config(sku_variant_groups={"A": ["x", "y"], "B": ["z", "x"], "C": []})
    grouped = variant_groups(frame("vendor_item", [("x",), ("y",), ("b",), ("c",)]), config)
    assert rows(grouped, "vendor_item", "sku_group", "sku_display") == [
        ("b", "B", "z"), ("c", "C", "C"), ("x", "B", "z"), ("y", "A", "x")]


def test_months_of_the_sku_tables_have_skus(spark):
    columns = ("source string, location_code string, vendor_item string, item_description string,"
               " yyyymm string, total decimal(28,8), qty decimal(28,8), lines long")
    from decimal import Decimal as D
    data = spark.createDataFrame(
        [("distributor", "A", "S", "s", f"2025-0{m}", D(10 * m), D(1), 1) for m in (1, 2, 3)]
        + [("distributor", "A", None, "fee", "2025-04", D(5), D(0), 1),
           ("distributor", None, "S", "s", "2025-05", D(5), D(0), 1)], columns)
    months = metrics.sku_month_list(data)
    assert months == ["2025-01", "2025-02", "2025-03"]
    assert metrics.month_list(data)[-1] == "2025-05"
    assert [r.avg_sales_3m for r in metrics.sku_sales_3m(data, months).collect()] == [20.0]


def test_popular_sku_counts_variants_together(cells):
    config = Config(sku_variant_groups={"E-9": ["E9 5", "E9-G"], "Solo": None})
    data = cells(("A", "E9 5", "d", "2025-10", 1, 4), ("A", "e9/g", "d", "2025-09", 1, 3),
                 ("A", "Z", "d", "2025-10", 1, 6), ("B", "solo", "d", "2025-10", 1, 1),
                 ("C", "t2", "d", "2025-10", 1, -1), ("C", "t1", "d", "2025-10", 1, -1))
    groups = metrics.sku_group_qty(data, period(data), config)
    assert rows(groups, "location_code", "sku_group", "qty_3m") == [
        ("A", "E 9", 7.0), ("A", "Z", 6.0), ("B", "SOLO", 1.0), ("C", "T1", -1.0), ("C", "T2", -1.0)]
    expected = [("A", "E9 5"), ("B", "Solo"), ("C", "T1")]
    assert rows(metrics.most_popular_sku(groups)) == expected
    direct = views.snapshot_metrics(data, period(data), config)
    assert rows(direct, "location_code", "most_popular_sku") == expected


def test_top_skus(cells, one_map):
    config = Config(report_month="2025-10", top_n=2)
    data = cells(("A", "b", "short", "2025-10", 1, 5), ("A", "a", "d", "2025-09", 1, 5),
                 ("A", "c", "d", "2025-10", 1, 4), ("A", "old", "d", "2025-06", 1, 90),
                 ("A", None, "d", "2025-10", 1, 90), ("B", "b", "longer text", "2025-10", 1, -2),
                 ("B", "b", "longer text", "2025-05", 1, 8))
    descriptions = skus.canonical_description(data)
    top = views.top_skus(data, descriptions, one_map, period(data), config)
    assert rows(top, "location_code", "crm_customer_id", "vendor_item", "item_description",
                "last_month_qty", "avg_qty_3m", "avg_qty_6m", "sku_rank") == [
        ("A", "1", "a", "d", 0.0, 2.5, 1.2, 1), ("A", "1", "b", "longer text", 5.0, 2.5, 1.2, 2),
        ("B", None, "b", "longer text", -2.0, -1.0, 1.5, 1)]


def test_descriptions(cells):
    data = cells(("A", "1", "bb", "m", 0, 0), ("B", "1", "aa", "m", 0, 0), ("A", "2", "x", "m", 0, 0),
                 ("A", "2", None, "m", 0, 0), ("A", "3", "nine chars", "m", 0, 0),
                 ("A", "3", "y", "m", 0, 0), ("A", None, "zzz", "m", 0, 0))
    assert rows(skus.canonical_description(data)) == [
        ("1", "aa"), ("2", None), ("3", "nine chars")]


def test_wide_views(cells, one_map):
    data = cells(("A", "1", "d", "2025-10", 3, 1), ("A", "2", "d", "2025-08", 4, 2),
                 ("B", "1", "d", "2025-08", -1, 5), ("A", None, "d", "2025-08", 10, 1),
                 ("Z", "1", "d", None, 10, 1))
    months = metrics.month_list(data)
    wide = views.sales_by_location_month(data, one_map, months)
    assert wide.columns[-2:] == ["2025-08", "2025-10"]
    assert rows(wide) == [("A", "Ann", "distributor", "1", "Ann Inc", 14.0, 3.0),
                          ("B", None, None, None, None, -1.0, 0.0)]
    descriptions = skus.canonical_description(data)
    by_sku = views.sales_by_sku_location_month(data, descriptions, one_map, months)
    assert rows(by_sku, "location_code", "vendor_item", "`2025-08`", "`2025-10`") == [
        ("A", "1", 0.0, 3.0), ("A", "2", 4.0, 0.0), ("B", "1", -1.0, 0.0)]
    units = views.qty_by_sku_location_month(data, descriptions, one_map, months)
    long = views.by_sku_location_month_long(data)
    assert units.agg(F.sum("`2025-08`") + F.sum("`2025-10`")).first()[0] == float(
        long.agg(F.sum("qty")).first()[0])


def test_sales_of_the_last_three_months_present(cells):
    data = cells(("A", "1", "d", "2025-10", 3, 1), ("A", "1", "d", "2025-05", 6, 1),
                 ("A", "1", "d", "2025-02", 9, 1), ("B", "1", "d", "2025-01", 99, 1))
    found = metrics.sku_sales_3m(data, metrics.month_list(data))
    assert rows(found) == [("A", "1", 6.0), ("B", "1", 0.0)]


def test_aliases(frame):
    sales = frame("vendor_item, n", [("OLD", "1"), ("X", "2"), (None, "3")])
    aliases = frame("excel_sku, mapped_sku", [("OLD", "NEW"), ("OLD", "NEWER"), (None, "NO")])
    assert rows(skus.apply_sku_aliases(sales, aliases), "n", "vendor_item") == [
        ("1", "NEW"), ("2", "X"), ("3", None)]


SALES = ("source string, location_code string, invoice_num string, yyyymm string,"
         " total decimal(28,8), qty decimal(28,8)")


def test_deduplicated_cells_equal_cells_of_deduplicated_sales(spark):
    sales = spark.sql(
        """select if(id % 3 = 0, 'distributor', if(id % 5 = 0, 'chain_a', 'chain_b')) source,
             if(id % 11 = 0, null, concat('L', if(id % 2 = 0, 1, id % 17))) location_code,
             concat('2025-0', 1 + id % 4) yyyymm, cast(id as decimal(28,8)) total,
             cast(1 as decimal(28,8)) qty from range(2000)""")
    grain = ("source", "location_code", "yyyymm")
    assert rows(sales_cells(sales, grain)) == rows(
        sum_cells(unify.precedence_dedup(sales), grain))


def test_run_profile_and_reconciliation(spark):
    from decimal import Decimal as D

    sales = spark.createDataFrame(
        [("distributor", "A", "i1", "2025-01", D(5), D(1)), ("chain_a", "A", "i1", "2025-02", D(5), D(1)),
         ("distributor", "B", "i2", "2025-03", D(5), D(1)), ("chain_b", None, "i3", None, D(5), D(1))],
        SALES)
    profile = quality.run_profile(sales_cells(sales, ("source", "location_code", "yyyymm")))
    assert profile.first().asDict() == {
        "transactions": 3, "rows_without_location": 1, "locations": 2, "first_month": "2025-02",
        "last_month": "2025-03", "distributor_rows": 1, "chain_a_rows": 1, "chain_b_rows": 1}
    assert rows(quality.reconcile_invoices(sales)) == [("after", 2, 0), ("before", 2, 1)]


def test_totals_against_an_independent_view(spark):
    schema = "location_code string, yyyymm string, total double"
    view = spark.createDataFrame([("A", "1", 1.0), ("B", "1", 2.0), ("C", "1", 3.0)], schema)
    other = spark.createDataFrame([("A", "1", 1.004), ("B", "1", 2.1), ("D", "1", 3.0)], schema)
    compared = quality.reconcile_totals(view, other)
    assert rows(compared, "location_code", "status") == [
        ("A", "equal"), ("B", "different"), ("C", "not expected"), ("D", "missing")]


def test_quantities_and_grains_are_reconciled(spark):
    schema = ("location_code string, vendor_item string, yyyymm string, total double, qty double")
    view = spark.createDataFrame(
        [("A", "X", "1", 5.0, 1.0), ("A", "Y", "1", 5.0, 2.0), ("A", None, "1", 1.0, 0.0),
         ("B", "X", "1", 3.0, 3.0), (None, "X", "1", 9.0, 9.0), ("A", "X", None, 9.0, 9.0)], schema)
    lines = spark.createDataFrame(
        [("A", "X", "1", 2.0, 1.0), ("A", "X", "1", 3.0, 1.0), ("A", "Y", "1", 6.0, 1.0),
         ("C", "X", "2", 1.0, 1.0)], schema)
    compared = quality.reconcile_totals(view, lines)
    got = {(r.grain, r.location_code, r.vendor_item, r.measure): (
        r.view_value and float(r.view_value), r.expected_value and float(r.expected_value), r.status)
        for r in compared.collect()}
    loc, sku = quality.BY_LOCATION, quality.BY_SKU
    assert got == {
        (loc, "A", None, "sales"): (11.0, 11.0, "equal"),
        (loc, "A", None, "quantity"): (3.0, 3.0, "equal"),
        (loc, "B", None, "sales"): (3.0, None, "not expected"),
        (loc, "B", None, "quantity"): (3.0, None, "not expected"),
        (loc, "C", None, "sales"): (None, 1.0, "missing"),
        (loc, "C", None, "quantity"): (None, 1.0, "missing"),
        (sku, "A", "X", "sales"): (5.0, 5.0, "equal"),
        (sku, "A", "X", "quantity"): (1.0, 2.0, "different"),
        (sku, "A", "Y", "sales"): (5.0, 6.0, "different"),
        (sku, "A", "Y", "quantity"): (2.0, 1.0, "different"),
        (sku, "B", "X", "sales"): (3.0, None, "not expected"),
        (sku, "B", "X", "quantity"): (3.0, None, "not expected"),
        (sku, "C", "X", "sales"): (None, 1.0, "missing"),
        (sku, "C", "X", "quantity"): (None, 1.0, "missing"),
    }
    summary = {(r.grain, r.measure, r.status): r["keys"]
               for r in quality.reconciliation_summary(compared).collect()}
    assert summary[sku, "sales", "different"] == 1 and summary[loc, "sales", "missing"] == 1


def test_the_audit_is_observed_while_cells_are_written(spark):
    from decimal import Decimal as D

    sales = spark.createDataFrame(
        [("distributor", "A", "i1", "2025-01", D(5), D(1)), ("distributor", "A", "i1", "2025-01", D(5), D(1)),
         ("chain_a", "A", "i1", "2025-02", D(5), D(1)), ("distributor", "B", "i2", "2025-03", D(5), D(1)),
         ("chain_b", None, "i3", None, D(5), D(1))], SALES)
    grain = ("source", "location_code", "yyyymm")
    cells, audit = observed_cells(sales, grain)
    assert rows(quality.dedup_audit(audit, spark)) == rows(unify.dedup_audit(sales)) == [(3, 1, 2)]
    assert rows(quality.observed_profile(audit, cells)) == rows(quality.run_profile(cells))
    empty, audit = observed_cells(sales.where("source = 'none'"), grain)
    assert rows(quality.dedup_audit(audit, spark)) == [(0, 0, 0)]
    assert rows(quality.observed_profile(audit, empty)) == rows(quality.run_profile(empty))
