from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from storeledger.config import STANDARD_COLUMNS
from storeledger.operators import unify
from storeledger.operators.standardize import filter_detail, normalize_columns, standardize
from storeledger.sources.reports import all_sales
from tests.conftest import rows


def test_detail_rows(frame):
    df = frame("id, record_type", [("a", "1"), ("b", "2"), ("c", "1.0"), ("d", "x"), ("e", None)])
    assert rows(filter_detail(df), "id") == [("a",), ("c",)]


def test_reports_without_record_type_keep_all_rows(frame):
    assert filter_detail(frame("id", [("a",), ("b",)])).count() == 2


def test_standard_columns(frame):
    raw = normalize_columns(
        frame("a, b, c, d, e, f, g",
              [(" K 1", " C1 ", "3", "bad", "1/5/70", "1 Main", " 77 ")]).toDF(
            "Vendor Item", "Customer", "Ship\nQty", "Total", "Invoice Date", "Address1", "Invoice"
        )
    )
    df = standardize(raw, "distributor")
    assert df.columns == list(STANDARD_COLUMNS)
    row = df.first()
    assert row["vendor_item"] == " K 1"  # SKUs are not trimmed
    assert (row["location_code"], row["invoice_num"]) == ("C1", "77")
    assert (row["qty"], row["unit_price"], row["total"]) == (3, 0, 0)
    assert row["invoice_date"] == datetime.date(1970, 1, 5)
    assert row["yyyymm"] == "1970-01"
    assert row["address"] == "1 Main"
    assert row["city"] is None and row["zip"] is None


def test_typed_input_columns(spark):
    raw = spark.sql(
        "select 'C' customer, 2.5D ship_qty, 10 total, date'2025-03-01' invoice_date, 5 zipcode"
    )
    row = standardize(raw, "distributor").first()
    assert (row["qty"], row["total"], row["yyyymm"], row["zip"]) == (2.5, 10, "2025-03", "5")


SALES = "source, location_code, vendor_item"


def test_chain_sales_replace_distributor_sales(frame):
    sales = frame(SALES, [
        ("distributor", "A", "1"), ("distributor", "B", "2"), ("distributor", None, "3"),
        ("chain_a", "B", "4"), ("chain_b", "B", "5"), ("chain_a", None, "6"),
    ])
    kept = unify.precedence_dedup(sales)
    assert rows(kept, "vendor_item") == [("1",), ("3",), ("4",), ("5",), ("6",)]
    assert rows(unify.precedence_dedup(kept)) == rows(kept)  # twice equals once
    audit = unify.dedup_audit(sales).first()
    assert tuple(audit) == (3, 2, 1)


def test_union_fills_missing_columns(frame):
    a, b = frame("x, y", [("1", "2")]), frame("y, z", [("3", "4")])
    assert rows(unify.unify(a, b)) == [("1", "2", None), (None, "3", "4")]


def test_sources_use_their_own_location_column(frame):
    columns = "customer, location, total, invoice_date, record_type"
    distributor = frame(columns, [("C1", "x", "5", "1/1/25", "1"), ("C9", "x", "5", "1/1/25", "2")])
    chain = frame(columns, [("x", "L1", "7", "1/1/25", "1")])
    sales = all_sales(distributor, chain, chain.limit(0))
    assert rows(sales, "source", "location_code", F.col("total").cast("int")) == [
        ("chain_a", "L1", 7), ("distributor", "C1", 5),
    ]
