"""Generated code that the JVM compiles: it leaves methods of over 8,000 bytes interpreted."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from storeledger.plans import views
from storeledger.sources import reports
from storeledger.workload import queries

LIMIT = 8000


def longest_method(df) -> int:
    debug = df.sparkSession._jvm.org.apache.spark.sql.execution.debug.package
    code = debug.codegenString(df._jdf.queryExecution().executedPlan())
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code)))


def test_month_columns_are_compiled(spark):
    months = [f"{1995 + i // 12}-{i % 12 + 1:02d}" for i in range(80)]
    values = F.map_from_arrays(F.array(F.lit(months[3])), F.array(F.col("id").cast("decimal(38,8)")))
    rows = spark.range(3).select("id", F.lit("x").alias("code"), values.alias("values"))
    wide = views._month_columns(rows, ["id", "code"], months)
    assert [r[months[3]] for r in wide.orderBy("id").collect()] == [0.0, 1.0, 2.0]
    assert {r[months[2]] for r in wide.collect()} == {0.0}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert longest_method(views._month_columns(rows, ["id", "code"], months)) < LIMIT
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_report_lines_are_compiled(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = queries.scan_reports(spark, "/root/testdata/sf0.001")
        assert longest_method(read) < LIMIT
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_column_the_file_lacks_is_null(spark, tmp_path):
    """Columns in another order than they are read in, and one that the file lacks."""
    header = ",".join(reversed([c for c in reports.REPORT_COLUMNS if c != "location"]))
    (tmp_path / "a.csv").write_text(f"Title\n\n{header}\n" + ",".join("1" * 15) + "\n")
    row = reports.read_reports(spark, str(tmp_path / "a.csv"), multi_line=False).first()
    assert row["location"] is None and row["vendor_item"] == row["record_type"] == "1"
