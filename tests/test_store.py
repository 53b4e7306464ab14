"""Report tables kept from run to run, and forms delivered once."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from storeledger.config import Config
from storeledger.plans import run as runs
from storeledger.plans import store
from storeledger.sources.customers import targets
from storeledger.sources.reports import all_sales
from tests.conftest import rows
from tests.test_run import CHAIN_A, CHAIN_B, COLUMNS, DISTRIBUTOR, line
from storeledger.sources.customers import crm_ref


@pytest.fixture
def prepared(spark):
    def make(distributor, report_month=None):
        lines = (distributor, CHAIN_A, CHAIN_B)
        sales = all_sales(*[spark.createDataFrame(r, COLUMNS) for r in lines])
        crm = crm_ref(spark.createDataFrame(
            [("ACME-EAST", "501.0", None, "9 Pine", 0)],
            "`Customer Name` string, `Customer ID *` string, `Location Name` string,"
            " `Street Address 1 *` string, ref_ord bigint"))
        return runs.run(sales, crm, Config(report_month=report_month))

    return make


def files(folder) -> dict[str, int]:
    found = Path(folder).rglob("*.parquet")
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in found if p.is_file()}


def same_tables(spark, folder, run):
    for name, table in run.views().items():
        read = store.read_report_table(spark, folder, name)
        assert rows(read, *table.columns) == rows(table), name


def test_only_changed_months_are_written(spark, prepared, tmp_path):
    folder = str(tmp_path / "store")
    first = prepared(DISTRIBUTOR)
    changed = store.store_report_tables(first, folder)
    months = ["2025-08", "2025-10"]
    assert changed == {store.BY_LOCATION: months, store.BY_SKU: months}
    same_tables(spark, folder, first)

    before = files(folder)
    assert store.store_report_tables(first, folder) == {store.BY_LOCATION: [], store.BY_SKU: []}
    long = {k: v for k, v in files(folder).items() if "yyyymm=" in k}
    assert long == {k: v for k, v in before.items() if "yyyymm=" in k}

    # one more sale in October, and a first one in November
    more = [line("MOP", "Mop", "A1", "Acme East", "10/09/25", "1", "7"),
            line("MOP", "Mop", "A1", "Acme East", "11/09/25", "1", "8")]
    later = prepared(DISTRIBUTOR + more)
    changed = store.store_report_tables(later, folder)
    assert changed[store.BY_SKU] == ["2025-10", "2025-11"]
    now = files(folder)
    august = [k for k in now if "yyyymm=2025-08" in k]
    assert august and all(now[k] == before[k] for k in august)
    read = {n: store.read_report_table(spark, folder, n) for n in later.views()}
    for name in ("sales_by_location_month", "sales_by_sku_location_month",
                 "qty_by_sku_location_month"):
        assert rows(read[name], *later.views()[name].columns) == rows(later.views()[name])
    # both report months are there
    assert {r.report_month for r in read["location_snapshot"].collect()} == {"2025-10", "2025-11"}


def test_a_month_without_sales_goes(spark, prepared, tmp_path):
    folder = str(tmp_path / "store")
    extra = [line("MOP", "Mop", "A1", "Acme East", "09/09/25", "1", "8")]
    store.store_report_tables(prepared(DISTRIBUTOR + extra), folder)
    run = prepared(DISTRIBUTOR)
    assert store.store_report_tables(run, folder)[store.BY_LOCATION] == ["2025-09"]
    same_tables(spark, folder, run)


def test_swapped_amounts_are_a_change(spark, tmp_path):
    path = str(tmp_path / "months")
    kind = "location_code string, yyyymm string, total double"
    one = spark.createDataFrame([("A", "2025-01", 1.0), ("B", "2025-01", 2.0)], kind)
    two = spark.createDataFrame([("A", "2025-01", 2.0), ("B", "2025-01", 1.0)], kind)
    assert store.store_months(one, path) == ["2025-01"]
    assert store.store_months(one, path) == []
    assert store.store_months(two, path) == ["2025-01"]
    assert rows(spark.read.parquet(path), "location_code", "total") == [("A", 2.0), ("B", 1.0)]
    assert store.store_months(one.where("false"), path) == ["2025-01"]


def test_forms_are_delivered_once(spark, prepared, tmp_path):
    listed = targets(spark.createDataFrame(
        [("501", "t1", "Acme", "A1", "distributor"), ("9", "t2", "Nobody", "zz", "chain_a"),
         (None, "t3", "Juice", "J9", "chain_b")],
        "crm_customer_id string, target_id string, customer_label string, location_code string,"
        " chain string"))
    path = str(tmp_path / "forms")
    run = prepared(DISTRIBUTOR)
    forms = runs.run_forms(run, listed)

    def states(built):
        return dict(rows(runs.deliver(built, path), "target_id", "status"))

    # a run that was cut short has written one form
    part = runs.Forms(forms.resolved.where("target_id = 't1'"), forms.fields,
                      forms.payloads.where("target_id = 't1'"))
    assert states(part) == {"t1": "delivered"}
    assert states(forms) == {"t1": "already there", "t2": "skipped", "t3": "delivered"}
    assert states(forms) == {"t1": "already there", "t2": "skipped", "t3": "already there"}
    read = runs.delivered(spark, path)
    wanted = forms.payloads.drop("target_ord")
    columns = wanted.withColumn("fields", F.to_json("fields")).columns
    assert rows(read.withColumn("fields", F.to_json("fields")), *columns) == rows(
        wanted.withColumn("fields", F.to_json("fields")))
    # another month's forms are new ones
    other = runs.run_forms(prepared(DISTRIBUTOR, "2025-08"), listed)
    assert states(other)["t1"] == "delivered"
    assert runs.delivered(spark, path).count() == 4
