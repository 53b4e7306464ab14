from __future__ import annotations

import xml.etree.ElementTree as ET

import pytest

from storeledger.config import Config
from storeledger.operators import payloads, targets
from storeledger.plans.run import build_forms, write_payloads
from storeledger.sources import customers
from tests.conftest import rows


@pytest.fixture
def listed(frame):
    raw = frame(
        "a, b, c, d, target_ord bigint",
        [("11.0", "901", "Ann", " A ", 1), ("22", "902", "Bob", "", 2), ("33", "903", "Cy", "gone", 3),
         ("11", "904", "Dee", "nan", 4), (None, "905", "Eve", "C", 5)],
    ).toDF(" CRM_Customer_ID", "Target_ID", "Customer_Label ", "location_code", "target_ord")
    return customers.targets(raw)


@pytest.fixture
def snapshot(spark):
    return spark.createDataFrame(
        [("A", "11", "2025-10", 1234.5), ("B1", "22", "2025-10", 10.0), ("B2", "22", "2025-10", 20.0),
         ("C", "", "2025-10", 0.0)],
        "location_code string, crm_customer_id string, report_month string, last_month_total double",
    )


@pytest.fixture
def top(spark):
    data = [("A", "11", "k<1>", 3.6, 2.5, 1), ("A", "11", "k&2", 1.5, 3.5, 2)]
    data += [("B1", "22", f"s{i}", 1.0, 1.0, i) for i in range(1, 8)]
    data += [("B2", "22", f"t{i}", 2.0, 1.0, i) for i in range(1, 8)]
    return spark.createDataFrame(
        data, "location_code string, crm_customer_id string, vendor_item string,"
        " last_month_qty double, avg_qty_3m double, sku_rank int")


@pytest.fixture
def sku_sales(spark):
    return spark.createDataFrame(
        [("A", "k<1>", 1492.845), ("B1", "s1", 7.0)],
        "location_code string, vendor_item string, avg_sales_3m double")


def test_target_list(listed):
    assert rows(listed, "target_ord", "crm_customer_id", "location_code") == [
        (1, "11", "A"), (2, "22", None), (3, "33", "gone"), (4, "11", None), (5, None, "C")]


def test_required_columns(frame):
    with pytest.raises(ValueError, match="target_id"):
        customers.targets(frame("crm_customer_id", [("1",)]))


def test_selection(listed):
    def chosen(*only):
        return [r[0] for r in rows(customers.select_targets(listed, only), "target_ord")]

    assert chosen("11") == [1, 4]
    assert chosen(" ANN ", "905", "GONE") == [1, 3, 5]
    with pytest.raises(ValueError):
        chosen("nobody")


def test_location_first_then_last_location_of_the_customer(listed, snapshot):
    resolved = targets.resolve_targets(listed, snapshot)
    assert rows(resolved, "target_ord", "key_kind", "key", "last_month_total") == [
        (1, "location", "A", 1234.5), (2, "customer", "22", 20.0), (3, None, None, None),
        (4, "customer", "11", 1234.5), (5, "location", "C", 0.0)]
    assert rows(targets.unresolved_targets(resolved), "target_id") == [("903",)]
    assert rows(payloads.delivery_status(resolved)) == [("ready", 4), ("skipped", 1)]


def test_customer_targets_list_locations_in_order_and_count_all_units(listed, snapshot, top):
    resolved = targets.resolve_targets(listed, snapshot)
    skus = targets.target_skus(resolved, top, Config())
    mine = [r[1:] for r in rows(skus, "target_ord", "position", "vendor_item") if r[0] == 2]
    assert sorted(mine) == [(i, f"s{i}") for i in range(1, 8)] + [(8, "t1"), (9, "t2"), (10, "t3")]
    units = targets.target_units(resolved, top)
    assert rows(units, "target_ord", "total_units", "sku_rows") == [
        (1, 5, 2), (2, 21, 14), (4, 5, 2), (5, 0, 0)]  # 5.1 is cut to 5


def test_forms(listed, snapshot, top, sku_sales):
    forms = build_forms(listed, snapshot, top, sku_sales, Config())
    mine = [r[1:] for r in rows(forms.fields, "target_ord", "position", "api_name", "name",
                                "field_type", "value") if r[0] == 1]
    assert sorted(mine) == [
        (1, "ReportMonth", "Report Month", 1, "2025-10"),
        (2, "TotalSales", "Total Sales", 1, "$1,234.50"),
        (3, "TotalUnits", "Total Units", 2, "5"),
        (4, "TopSKU1", "Top SKU #1", 1, f"k<1> | ${1492.845:,.2f} | 2 units/mo"),
        (5, "TopSKU2", "Top SKU #2", 1, "k&2 | $0.00 | 4 units/mo"),
    ]
    # a target found through its customer has no sales of its own location
    by_id = [r for r in rows(forms.fields, "target_ord", "value") if r[0] in (2, 4)]
    assert all("$0.00" in v for _, v in by_id if "units/mo" in v)
    found = {r["target_id"]: r for r in forms.payloads.collect()}
    assert set(found) == {"901", "902", "904", "905"}
    assert (found["901"]["holder_id"], found["901"]["holder_type"]) == ("11", 2)
    assert (found["905"]["holder_id"], found["905"]["holder_type"]) == (None, None)
    assert [f["api_name"] for f in found["905"]["fields"]] == [
        "ReportMonth", "TotalSales", "TotalUnits"]
    assert [f["value"] for f in found["902"]["fields"]][3].startswith("s1 | ")


def test_xml_reads_back(spark, listed, snapshot, top, sku_sales, tmp_path):
    forms = build_forms(listed, snapshot, top, sku_sales, Config())
    texts = dict(rows(payloads.form_xml(forms.payloads, "report"), "target_id", "xml"))
    for payload in forms.payloads.collect():
        root = ET.fromstring(texts[payload["target_id"]])
        assert root.tag == "report"
        assert root.findtext("filledFormId") == payload["target_id"]
        assert root.findtext("holderId") == payload["holder_id"]
        values = [f.findtext("value") for f in root.iter("formField")]
        assert values == [f["value"] for f in payload["fields"]]
    path = str(tmp_path / "forms")
    write_payloads(forms.payloads, path, "report")
    written = spark.read.format("xml").option("rowTag", "report").load(path)
    assert written.count() == 4
