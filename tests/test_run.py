"""The whole run on an invented fixture, against tables written by hand."""

from __future__ import annotations

import pytest

from storeledger.config import Config
from storeledger.operators import quality
from storeledger.plans.run import run, run_forms
from storeledger.sources.customers import crm_ref, targets
from storeledger.sources.reports import all_sales
from tests.conftest import rows

COLUMNS = ("vendor_item string, item_description string, customer string, location string,"
           " customer_name string, address1 string, address2 string, city string, state string,"
           " zipcode string, invoice string, invoice_date string, ship_qty string,"
           " net_price string, total string, record_type string")


def line(sku, text, code, name, date, qty, total, kind="1", invoice="1", address="1 Elm Street"):
    return (sku, text, code, code, name, address, None, "Town", None, "07001", invoice, date, qty,
            "1", total, kind)


DISTRIBUTOR = [
    line("SOAP", "Soap", "A1", "Acme East", "08/05/25", "4", "1200.00"),
    line("SOAP", "Soap, liquid", "A1", "Acme East", "10/05/25", "2", "600.50"),
    line("MOP", "Mop", "A1", "Acme East", "10/06/25", "9", "30"),
    line("MOP", "Mop", "A1", "* Item Total *", "10/06/25", "9", "30", kind="2"),
    line("MOP", "Mop", "B2", "Lone Diner", "10/06/25", "1", "oops"),
    line("MOP", "Mop", "Q7", "COMMISSARY", "10/07/25", "5", "500"),
    line("MOP", "Mop", "B2", "Lone Diner", "bad date", "1", "75"),
    line("MOP", "Mop", None, "Nobody", "10/06/25", "1", "20"),
]
CHAIN_A = [line("SOAP", "Soap", "Q7", "LPQ 8431 LINDEN WY", "10/07/25", "5", "500", address="x")]
CHAIN_B = [line("WAX", "Wax", "J9", "JOE 5 PARK", "08/01/25", "1", "10", address="x")]


@pytest.fixture(scope="module")
def done(spark):
    sales = all_sales(*[spark.createDataFrame(r, COLUMNS) for r in (DISTRIBUTOR, CHAIN_A, CHAIN_B)])
    crm = crm_ref(spark.createDataFrame(
        [("ACME-EAST", "501.0", None, "9 Pine", 0), ("LPQ Bakery", "502", None, "8431 Linden Way", 1)],
        "`Customer Name` string, `Customer ID *` string, `Location Name` string,"
        " `Street Address 1 *` string, ref_ord bigint"))
    return run(sales, crm, Config())


def test_location_map(done):
    assert rows(done.location_map) == [
        ("A1", "distributor", "Acme East", "1 Elm Street", "Town", "", "07001", "501", "ACME-EAST"),
        ("B2", "distributor", "Lone Diner", "1 Elm Street", "Town", "", "07001", "", ""),
        ("J9", "chain_b", "JOE 5 PARK", "x", "Town", "", "07001", "", ""),
        ("Q7", "chain_a", "LPQ 8431 LINDEN WY", "x", "Town", "", "07001", "502", "LPQ Bakery"),
    ]
    assert tuple(quality.mapping_coverage(done.location_map).first()) == (4, 2, 2)


def test_all_five_tables(done):
    tables = done.views()
    assert rows(tables["sales_by_location_month"]) == [
        ("A1", "Acme East", "distributor", "501", "ACME-EAST", 1200.0, 630.5),
        ("B2", "Lone Diner", "distributor", "", "", 0.0, 0.0),
        ("J9", "JOE 5 PARK", "chain_b", "", "", 10.0, 0.0),
        ("Q7", "LPQ 8431 LINDEN WY", "chain_a", "502", "LPQ Bakery", 0.0, 500.0),
    ]
    assert rows(tables["sales_by_sku_location_month"]) == [
        ("A1", "distributor", "501", "MOP", "Mop", 0.0, 30.0),
        ("A1", "distributor", "501", "SOAP", "Soap, liquid", 1200.0, 600.5),
        ("B2", "distributor", "", "MOP", "Mop", 0.0, 0.0),
        ("J9", "chain_b", "", "WAX", "Wax", 10.0, 0.0),
        ("Q7", "chain_a", "502", "SOAP", "Soap, liquid", 0.0, 500.0),
    ]
    assert rows(tables["qty_by_sku_location_month"], "location_code", "vendor_item", "`2025-08`",
                "`2025-10`") == [
        ("A1", "MOP", 0.0, 9.0), ("A1", "SOAP", 4.0, 2.0), ("B2", "MOP", 0.0, 1.0),
        ("J9", "WAX", 1.0, 0.0), ("Q7", "SOAP", 0.0, 5.0),
    ]
    assert rows(tables["location_snapshot"], "location_code", "last_month_total",
                "avg_monthly_3m", "avg_monthly_6m", "sla_tier", "visit_frequency",
                "most_popular_sku", "report_month") == [
        ("A1", 630.5, 915.25, 915.25, "Tier 1", "Monthly", "MOP", "2025-10"),
        ("B2", 0.0, 0.0, 0.0, "Tier 4", "Annually", "MOP", "2025-10"),
        ("J9", 0.0, 5.0, 5.0, "Tier 4", "Annually", "WAX", "2025-10"),
        ("Q7", 500.0, 250.0, 250.0, "Tier 4", "Annually", "SOAP", "2025-10"),
    ]
    assert rows(tables["top_skus"], "location_code", "vendor_item", "last_month_qty",
                "avg_qty_3m", "sku_rank") == [
        ("A1", "MOP", 9.0, 4.5, 1), ("A1", "SOAP", 2.0, 3.0, 2), ("B2", "MOP", 1.0, 0.5, 1),
        ("J9", "WAX", 0.0, 0.5, 1), ("Q7", "SOAP", 5.0, 2.5, 1),
    ]


def test_profile(done):
    assert quality.run_profile(done.cells).first().asDict() == {
        "transactions": 8, "rows_without_location": 1, "locations": 4, "first_month": "2025-08",
        "last_month": "2025-10", "distributor_rows": 6, "chain_a_rows": 1, "chain_b_rows": 1}


def test_forms(done, frame):
    listed = targets(frame("crm_customer_id, target_id, location_code, target_ord bigint",
                           [("501", "1", "A1", 1), ("502.0", "2", None, 2), ("9", "3", "zz", 3)]))
    forms = run_forms(done, listed)
    values = {r["target_id"]: [f["value"] for f in r["fields"]] for r in forms.payloads.collect()}
    assert values == {
        "1": ["2025-10", "$630.50", "11", "MOP | $15.00 | 4 units/mo", "SOAP | $900.25 | 3 units/mo"],
        "2": ["2025-10", "$500.00", "5", "SOAP | $0.00 | 2 units/mo"],
    }


def test_aliases_and_overrides_when_given(done, frame):
    aliases = frame("excel_sku, mapped_sku", [("SOAP", "MOP")])
    manual = frame("excel_customer, excel_shipto, crm_customer_id, crm_customer_name",
                   [("lone diner", "1 ELM STREET", "77", "Diner")])
    again = run(done.cells.drop("lines"), None, Config(), saved_map=done.location_map,
                overrides=manual, sku_aliases=aliases)
    assert rows(again.location_map, "location_code", "crm_customer_id") == [
        ("A1", "501"), ("B2", "77"), ("J9", ""), ("Q7", "502")]
    assert rows(again.top_skus(), "location_code", "vendor_item", "last_month_qty") == [
        ("A1", "MOP", 11.0), ("B2", "MOP", 1.0), ("J9", "WAX", 0.0), ("Q7", "MOP", 5.0)]


def test_saved_map(done, spark):
    saved = done.location_map.unionByName(done.location_map)  # codes repeated by hand
    again = run(done.cells.drop("lines"), None, Config(), saved_map=saved)
    assert rows(again.location_map.select(*done.location_map.columns)) == rows(done.location_map)
    assert again.location_snapshot().count() == 4
