"""Sales reports of the distributor and of the chains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.config import CHAIN_A, CHAIN_B, DISTRIBUTOR
from storeledger.functions.numbers import to_number
from storeledger.functions.text import normalize_header
from storeledger.operators.standardize import filter_detail, normalize_columns, standardize
from storeledger.operators.unify import unify
from storeledger.sources.titled import check_columns, read_titled

REPORT_COLUMNS = (
    "vendor_item", "item_description", "invoice", "invoice_date", "customer", "location",
    "customer_name", "address1", "address2", "city", "state", "zipcode", "ship_qty",
    "net_price", "total", "record_type",
)


def read_reports(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    details_only: bool = True,
    multi_line: bool = True,
    required: Sequence[str] = ("customer", "invoice_date"),
) -> DataFrame:
    """Read report files that open with a title block, as text columns.

    ``sourcefile`` holds the file name. Header cells with line breaks need
    ``multi_line``, which makes a file one task; without such cells pass False
    and large files are split.
    """
    found = read_titled(
        spark, path, REPORT_COLUMNS, normalize_header, required=required, multi_line=multi_line
    )
    if details_only:
        typed = F.array_contains("names", "record_type")
        found = found.where(~typed | (to_number(F.col("record_type")) == 1))
    return found.select("sourcefile", *REPORT_COLUMNS)


def read_table(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """Read a table with its header on the first row, or a Parquet table.

    Without line breaks in cells pass ``multi_line=False``, and files are split.
    """
    if path.rstrip("/").endswith(".parquet"):
        raw = spark.read.parquet(path)
    else:
        raw = spark.read.csv(path, header=True, multiLine=multi_line)
    return normalize_columns(raw)


def distributor_sales(raw: DataFrame) -> DataFrame:
    check_columns(raw, ("customer", "invoice_date"))
    return standardize(filter_detail(raw), DISTRIBUTOR, "customer")


def chain_a_sales(raw: DataFrame) -> DataFrame:
    check_columns(raw, ("location", "invoice_date"))
    return standardize(filter_detail(raw), CHAIN_A, "location")


def chain_b_sales(raw: DataFrame) -> DataFrame:
    check_columns(raw, ("location", "invoice_date"))
    return standardize(filter_detail(raw), CHAIN_B, "location")


def all_sales(distributor: DataFrame, chain_a: DataFrame, chain_b: DataFrame) -> DataFrame:
    """Standardised union of the three raw reports, tagged with their source."""
    return unify(distributor_sales(distributor), chain_a_sales(chain_a), chain_b_sales(chain_b))


def file_row_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("sourcefile").agg(F.count("*").alias("rows"))
