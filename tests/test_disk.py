"""What a run leaves on disk while it lasts."""

from __future__ import annotations

import gzip
import time
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from storeledger import staging
from storeledger.plans import run as runs
from storeledger.sources import reports
from storeledger.workload import queries as q
from storeledger.workload import report_files
from tests.conftest import rows
from tests.test_plans import plan

SF = "/root/testdata/sf0.001"


def size_of(folder, suffix="") -> int:
    return sum(f.stat().st_size for f in Path(folder).rglob(f"part-*{suffix}"))


def test_wide_tables_take_little_more_than_their_sales(spark, tmp_path):
    months = [F.when(F.col("id") % 80 == m, 12.5).otherwise(0.0).alias(f"m{m}") for m in range(80)]
    wide = spark.range(4000).select(
        F.format_string('L"%d, x', "id").alias("location_code"), *months)
    runs.write_views({"wide": wide}, str(tmp_path))
    as_text = wide.select(F.sum(F.length(F.concat_ws(",", *wide.columns)))).first()[0]
    assert size_of(tmp_path / "wide") < as_text / 10
    read = spark.read.csv(str(tmp_path / "wide"), header=True)
    assert rows(read) == rows(wide.select(*[F.col(c).cast("string") for c in wide.columns]))


def shuffle_files(spark) -> set[Path]:
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for folder in disk.localDirsString() for f in Path(folder).rglob("shuffle_*.data")}


def test_shuffle_files_end_with_the_write_that_made_them(spark, tmp_path):
    before = shuffle_files(spark)
    summed = spark.range(50000).groupBy((F.col("id") % 9999).alias("key")).agg(F.sum("id").alias("s"))
    kept = staging.materialise(summed, "summed")
    runs.write_views({"wide": summed}, str(tmp_path))
    for _ in range(50):  # files are deleted in the background
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert kept.count() == spark.read.csv(str(tmp_path / "wide"), header=True).count() == 9999


def test_the_session_keeps_its_own_setting(spark):
    name = staging._CLEANUP
    given = spark.conf.get(name, None)
    staging.materialise(spark.range(3), "three")
    assert spark.conf.get(name, None) == given
    spark.conf.set(name, "false")
    try:
        staging.materialise(spark.range(3), "three")
        assert spark.conf.get(name) == "false"
    finally:
        spark.conf.unset(name)


REPORT = """Monthly report
Total,Record Type,Customer,Vendor Item,Invoice Date
7,1,C1,K9,x
8,2,C1,K10,x
9,1,"C, 2",K11,x
"""


@pytest.mark.parametrize("multi_line", [True, False])
def test_compressed_reports_give_the_rows_of_plain_ones(spark, tmp_path, multi_line):
    found = []
    for kind in ("plain", "packed"):
        (tmp_path / kind).mkdir()
        for name in ("jan.csv", "feb.csv"):
            if kind == "plain":
                (tmp_path / kind / name).write_text(REPORT)
            else:
                with gzip.open(tmp_path / kind / f"{name}.gz", "wt") as out:
                    out.write(REPORT)
        table = reports.read_reports(spark, f"{tmp_path}/{kind}/*", multi_line=multi_line)
        found.append((rows(table), rows(reports.file_row_counts(table))))
    assert found[0] == found[1] and found[1][1] == [("feb.csv", 2), ("jan.csv", 2)]


def test_reports_are_written_from_one_scan_of_the_lines_and_compressed(spark, monkeypatch):
    made = []

    def noting(writer, path, *given, real=DataFrameWriter.text, **named):
        made.append((path, plan(writer._df)))
        return real(writer, path, *given, **named)

    monkeypatch.setattr(DataFrameWriter, "text", noting)
    counted = rows(reports.file_row_counts(q._read_reports(spark, SF)))
    ((path, text),) = made
    assert text.count("lineitem.parquet") == 1
    files = [f for f in Path(path.removeprefix("file:")).rglob("distributor_*") if f.suffix == ".gz"]
    assert {f.name.removesuffix(".gz") for f in files} >= {name for name, _ in counted}
    assert sum(f.stat().st_size for f in files) < sum(
        len(gzip.decompress(f.read_bytes())) for f in files) / 2


def test_a_report_without_lines_has_no_rows(spark, frame, tmp_path):
    names = [name for name in reports.REPORT_COLUMNS if name not in ("location", "invoice")]
    invoices = frame("sourcefile, invoice", [
        ("x_2025-01.csv", " 2 "), ("x_2025-01.csv", " 3 "), ("x_2025-02.csv", " 4 ")])
    lines = invoices.limit(2).select(
        "*", *[F.lit("1").alias(name) for name in names], F.explode(F.array(F.lit(1), F.lit(2))))
    path = report_files.write_title_block_reports(lines, invoices, str(tmp_path / "reports"))
    table = reports.read_reports(spark, path, multi_line=False)
    assert rows(reports.file_row_counts(table)) == [
        ("distributor_2025-01_0.csv", 2), ("distributor_2025-01_1.csv", 2)]
    assert len(list(tmp_path.glob("reports/named/*.csv.gz"))) == 3
