"""Cells of a run, the places counted beside them, and the order of the joins that make sales."""

from __future__ import annotations

from storeledger.config import Config
from storeledger.operators.cells import FULL_GRAIN, PLACE, cells_and_places, observed_cells
from storeledger.operators.locations import location_ref
from storeledger.plans import run as runs
from storeledger.workload import star
from tests.conftest import rows
from tests.test_plans import SF, plan


def test_cells_are_not_repeated_per_place(spark, tmp_path):
    places = [("A", "1 Road", "X", "s", "z"), ("A", "1 Road, Back", "X", "s", "z"),
              (None, None, None, None, None)]
    made = spark.createDataFrame(
        [("distributor", code, "sku", "text", "2001-07", *place, i, 1)
         for code in ("L1", None) for i, place in enumerate(places * 2)],
        "source string, location_code string, vendor_item string, item_description string,"
        " yyyymm string, customer_name string, address string, city string, state string,"
        " zip string, total int, qty int",
    )
    crm = spark.createDataFrame(
        [], "ref_ord long, crm_customer_id string, crm_customer_name string, norm_name string,"
        " norm_addr string, norm_loc string")
    done = runs.run(made, crm, Config(report_month="2001-07"))
    assert rows(done.cells, "location_code", "total", "qty", "lines") == [
        ("L1", 15, 6, 6), (None, 15, 6, 6)]
    assert not set(PLACE) & set(done.cells.columns)
    assert rows(done.location_map, "location_code", "customer_name", "address") == [
        ("L1", "A", "1 Road")]
    assert done.audit.before["lines"] == done.audit.after["lines"] == 12
    assert done.audit.after["unlocated"] == 6


def test_places_and_audit_equal_those_of_full_cells(spark):
    sales = star.tagged_sales(spark, SF)
    cells, places, audit = cells_and_places(sales, FULL_GRAIN)
    full, noted = observed_cells(sales, FULL_GRAIN)
    assert rows(location_ref(places)) == rows(location_ref(full))
    cells.count()
    assert audit == noted and audit.after["lines"] < audit.before["lines"]


def test_parts_are_joined_while_lines_are_narrow(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(star.tagged_sales(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.index("keys [1]: [l_partkey") < text.index("keys [1]: [l_orderkey")


def test_customers_are_not_the_small_side(spark):
    """A broadcast of the customers leaves the one file of nations to a single task."""
    assert "BuildLeft" not in plan(star.customers(spark, SF))
