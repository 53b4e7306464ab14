"""Report lines are parsed once."""

from __future__ import annotations

from storeledger.sources import reports
from tests.conftest import rows
from tests.test_plans import plan


def test_a_filter_on_a_column_does_not_parse_a_line_again(spark, tmp_path):
    fill = ",".join(f"x{i}" for i in range(9))
    (tmp_path / "jan.csv").write_text(
        f'Title, "12\nCustomer,Vendor Item,Invoice Date,{fill},Record Type\n'
        f"C1,K1,x,{fill},1\nC2,K2,x,{fill},2\n \nC3,K3,x,{fill},1.0\n")
    table = reports.read_reports(spark, str(tmp_path / "jan.csv"), multi_line=False)
    assert plan(table).count("from_csv(") == 1
    assert plan(reports.file_row_counts(table)).count("from_csv(") == 1
    assert rows(table, "customer", "vendor_item") == [("C1", "K1"), ("C3", "K3")]
