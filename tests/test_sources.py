from __future__ import annotations

import pytest

from storeledger.plans import run as runs
from storeledger.sources import customers, reports
from tests.conftest import rows

JAN = '''Monthly report

,,printed for internal use

"Vendor
Item",Customer,"Ship
Qty","Record
Type","Customer
Name",Total,Ignored,Invoice Date
K1, C1 ,2,1,"Ann, Inc",10.5,x,
K2,C2,3,2,* Item Total *,99,x,
K3,C3,4,1.0,"two
lines",1,x,
'''
FEB = '''Monthly report
Total,Record Type,Customer,Vendor Item,Invoice Date
7,1,C1,K9,
8,,C1,K10,
'''
PLAIN = '''Customer,Total,Vendor Item,Invoice Date
C4,5,K4,
'''


@pytest.fixture
def folder(tmp_path):
    for name, body in (("jan.csv", JAN), ("feb.csv", FEB), ("plain.csv", PLAIN)):
        (tmp_path / name).write_text(body)
    return str(tmp_path)


def test_title_block_is_skipped_and_columns_are_found_by_name(spark, folder):
    table = reports.read_reports(spark, f"{folder}/*.csv")
    assert rows(table, "sourcefile", "vendor_item", "customer", "ship_qty", "total",
                "customer_name") == [
        ("feb.csv", "K9", "C1", None, "7", None), ("jan.csv", "K1", " C1 ", "2", "10.5", "Ann, Inc"),
        ("jan.csv", "K3", "C3", "4", "1", "two\nlines"), ("plain.csv", "K4", "C4", None, "5", None)]
    assert rows(reports.file_row_counts(table)) == [
        ("feb.csv", 1), ("jan.csv", 2), ("plain.csv", 1)]


def test_all_rows_on_request(spark, folder):
    assert reports.read_reports(spark, f"{folder}/jan.csv", details_only=False).count() == 3


def test_split_files_find_the_same_rows(spark, tmp_path):
    lines = "".join(f"{i},1,C{i % 7},K{i},x\n" for i in range(20000))
    (tmp_path / "big.csv").write_text(
        "Title\nTotal,Record Type,Customer,Vendor Item,Invoice Date\n" + lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        table = reports.read_reports(spark, str(tmp_path / "big.csv"), multi_line=False)
        assert table.rdd.getNumPartitions() > 3
        assert table.count() == 20000
        assert table.where("vendor_item = concat('K', total)").count() == 20000
        chain = reports.read_table(spark, str(tmp_path / "big.csv"), multi_line=False)
        assert chain.rdd.getNumPartitions() > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_do_not_depend_on_how_files_are_packed(spark, tmp_path):
    for i in range(8):
        body = "".join(f"{j},C{j},K{j},x\n" for j in range(375))
        title = "Title\n" * (i + 1)
        (tmp_path / f"{i}.csv").write_text(f"{title}Total,Customer,Vendor Item,Invoice Date\n{body}")
    spark.conf.set("spark.sql.files.minPartitionNum", "8")
    try:
        table = reports.read_reports(spark, f"{tmp_path}/*.csv", multi_line=False)
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        assert table.count() == 3000
        assert table.where("vendor_item = 'K0'").count() == 8
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_wide_files_keep_their_columns(spark, tmp_path):
    fill = ",".join(f"x{i}" for i in range(70))
    (tmp_path / "wide.csv").write_text(
        f"Customer,Vendor Item,Invoice Date,{fill},Total\nC1,K1,x,{fill},12.5\n")
    table = reports.read_reports(spark, str(tmp_path / "wide.csv"))
    assert rows(table, "customer", "total") == [("C1", "12.5")]


def test_missing_header_or_column_is_an_error(spark, frame, tmp_path):
    (tmp_path / "good.csv").write_text("Customer,Vendor Item,Invoice Date\nC1,K1,x\n")
    (tmp_path / "bad.csv").write_text("Some,Other,File\n1,2,3\n")
    with pytest.raises(ValueError, match="no header row in .*bad.csv"):
        reports.read_reports(spark, f"{tmp_path}/*.csv")
    (tmp_path / "bad.csv").write_text("Customer,Vendor Item,Total\nC1,K1,x\n")
    with pytest.raises(ValueError, match="no column invoice_date in .*bad.csv"):
        reports.read_reports(spark, f"{tmp_path}/*.csv")
    with pytest.raises(ValueError, match="location"):
        reports.chain_a_sales(frame("invoice_date, total", [("x", "1")]))
    with pytest.raises(ValueError, match="customer"):
        reports.distributor_sales(frame("invoice_date, total", [("x", "1")]))


def test_no_report_files(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|no report files"):
        reports.read_reports(spark, f"{tmp_path}/*.csv")
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        reports.read_reports(spark, f"{tmp_path}/empty")


def test_tables_with_header_row(spark, tmp_path):
    (tmp_path / "chain.csv").write_text(
        '"Ship\nQty",Location,Record Type,Invoice Date\n5,L1,1,\n6,L2,2,\n')
    raw = reports.read_table(spark, str(tmp_path / "chain.csv"))
    assert raw.columns == ["ship_qty", "location", "record_type", "invoice_date"]
    sales = reports.chain_a_sales(raw)
    assert [(r["location_code"], int(r["qty"])) for r in sales.collect()] == [("L1", 5)]
    raw.write.parquet(str(tmp_path / "chain.parquet"))
    assert reports.read_table(spark, str(tmp_path / "chain.parquet")).count() == 2


def test_crm_file_keeps_its_order(spark, tmp_path):
    body = "Customers\n\nExported,today\n"
    body += "Customer Name,Customer ID *,Location Name,Street Address 1 *,Other\n"
    body += "Ann,007,,1 Elm,x\n,9,,2 Elm,x\nBob,x,Shop,3 Elm,x\n"
    (tmp_path / "crm.csv").write_text(body)
    crm = customers.read_crm(spark, str(tmp_path / "crm.csv"))
    found = crm.orderBy("ref_ord").collect()
    assert [(r["crm_customer_name"], r["crm_customer_id"]) for r in found] == [
        ("Ann", "7"), ("Bob", None)]


def test_ids_stay_text(spark, tmp_path):
    (tmp_path / "map.csv").write_text('location_code,crm_customer_id\n"A,1",00123\n')
    table = customers.read_typed_csv(
        spark, str(tmp_path / "map.csv"), "location_code string, crm_customer_id string")
    assert rows(table) == [("A,1", "00123")]


def test_typed_columns_are_bound_by_name(spark, tmp_path):
    (tmp_path / "map.csv").write_text("name,id\nAnn,007\n")
    table = customers.read_typed_csv(spark, str(tmp_path / "map.csv"), "id string, name string")
    assert rows(table) == [("007", "Ann")]
    with pytest.raises(ValueError, match="city"):
        customers.read_typed_csv(spark, str(tmp_path / "map.csv"), "id string, city string")


def test_saved_text_map_keeps_the_first_row_of_a_code(spark, tmp_path):
    path = tmp_path / "map.csv"
    path.write_text("location_code,chain,crm_customer_id,crm_customer_name\n"
                    "B,x,2,Two\nA,x,9,Corrected\nA,x,1,Old\n")
    saved = runs.saved_or_built(spark, str(path), lambda: None)
    assert rows(saved, "location_code", "crm_customer_id") == [("A", "9"), ("B", "2")]


def test_saved_map_is_reused(spark, frame, tmp_path):
    path = str(tmp_path / "map")
    built = []

    def build():
        built.append(1)
        return frame("location_code, crm_customer_id", [("A", "1"), ("B", ""), ("C", None)])

    for _ in range(2):
        assert runs.saved_or_built(spark, path, build).count() == 3
    assert len(built) == 1
    runs.saved_or_built(spark, path, build, reuse=False)
    assert len(built) == 2


def test_unmapped_locations_are_written_when_there_are_any(spark, frame, tmp_path):
    columns = "location_code, crm_customer_id"
    some = frame(columns, [("A", "1"), ("B", "")])
    out = [str(tmp_path / name) for name in ("m1", "u1", "m2", "u2")]
    assert runs.write_location_map(some, out[0], out[1]) == 1
    assert rows(spark.read.csv(out[1], header=True), "location_code") == [("B",)]
    assert runs.write_location_map(frame(columns, [("A", "1")]), out[2], out[3]) == 0
    assert not (tmp_path / "u2").exists()


def test_monthly_tables_keep_other_months(spark, frame, tmp_path):
    columns = "location_code, report_month"
    wide = frame("location_code, v", [("A", "1")])
    for month in ("2025-09", "2025-10", "2025-10"):
        runs.write_views({"snap": frame(columns, [("A", month)]), "wide": wide}, str(tmp_path))
    written = spark.read.schema("location_code string, report_month string").parquet(
        str(tmp_path / "snap"))
    assert rows(written) == [("A", "2025-09"), ("A", "2025-10")]
    assert rows(spark.read.csv(str(tmp_path / "wide"), header=True)) == [("A", "1")]


BROKEN_HEADER = '''Monthly report, 12" wide

,"Printed for
""internal"" use"
"Vendor
Item",Customer,"Ship
Qty","Record
Type","Customer, ""Name""",Total,"Invoice
Date"
'''


def test_header_cells_with_line_breaks_in_a_split_file(spark, tmp_path):
    lines = "".join(f'K{i},"C{i % 7}",{i},1,"Ann, ""{i}""",{i},x\n' for i in range(20000))
    (tmp_path / "big.csv").write_text(BROKEN_HEADER + lines)
    (tmp_path / "small.csv").write_text("\n\nTitle\nTotal,Customer,Vendor Item,Invoice Date\n1,C,K,x\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        table = reports.read_reports(spark, f"{tmp_path}/*.csv", multi_line=False)
        assert table.rdd.getNumPartitions() > 3
        big = table.where("sourcefile = 'big.csv'")
        assert big.count() == 20000
        assert big.where("vendor_item = concat('K', total) and ship_qty = total").count() == 20000
        assert big.where("customer like 'C_' and record_type = '1'").count() == 20000
        assert rows(table.where("sourcefile = 'small.csv'"), "customer", "total") == [("C", "1")]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_split_and_whole_files_give_the_same_rows(spark, folder, tmp_path):
    (tmp_path / "jan.csv").write_text(JAN.replace('"two\nlines"', '"two lines"') + "\n\nK5,C5\n")
    # another quoting, blank lines and short rows
    whole = reports.read_reports(spark, f"{folder}/*.csv", details_only=False)
    split = reports.read_reports(spark, f"{folder}/*.csv", details_only=False, multi_line=False)
    assert rows(whole) == rows(split) and len(rows(split)) == 7


def test_header_far_down_and_wide(spark, tmp_path):
    fill = ",".join(f"x{i}" for i in range(700))
    (tmp_path / "far.csv").write_text(
        "Title\n" * 900 + f"Customer,Vendor Item,Invoice Date,{fill},Total\nC1,K1,x,{fill},12.5\n")
    (tmp_path / "near.csv").write_text("Customer,Vendor Item,Invoice Date\nC2,K2,x,more,cells\n")
    table = reports.read_reports(spark, f"{tmp_path}/*.csv", multi_line=False)
    assert rows(table, "customer", "total") == [("C1", "12.5"), ("C2", None)]
    (tmp_path / "none.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="no header row in .*none.csv"):
        reports.read_reports(spark, f"{tmp_path}/*.csv", multi_line=False)
