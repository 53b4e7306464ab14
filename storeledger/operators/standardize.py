"""Raw report rows to the 15 standard columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeledger.config import STANDARD_COLUMNS
from storeledger.functions.months import month_key, parse_report_date
from storeledger.functions.numbers import to_amount, to_number
from storeledger.functions.text import concat_address, header_name, strip


def normalize_columns(raw: DataFrame) -> DataFrame:
    return raw.toDF(*[header_name(name) for name in raw.columns])


def filter_detail(raw: DataFrame) -> DataFrame:
    """Detail rows only; a report without record types has no other rows."""
    if "record_type" not in raw.columns:
        return raw
    return raw.where(to_number(F.col("record_type")) == 1)


def standardize(
    raw: DataFrame, source: str | Column, location: str | Column = "customer"
) -> DataFrame:
    """Project onto the standard columns; an absent input column becomes null."""
    types = {f.name: f.dataType for f in raw.schema.fields}

    def column(name: str) -> Column:
        return F.col(name) if name in types else F.lit(None).cast("string")

    def text(name: str) -> Column:
        return column(name).cast("string")

    def date(name: str) -> Column:
        is_text = isinstance(types.get(name, T.StringType()), T.StringType)
        return parse_report_date(column(name)) if is_text else column(name).cast("date")

    standard = raw.select(
        (F.lit(source) if isinstance(source, str) else source).alias("source"),
        text("vendor_item").alias("vendor_item"),
        text("item_description").alias("item_description"),
        strip(column(location) if isinstance(location, str) else location).alias("location_code"),
        text("customer_name").alias("customer_name"),
        concat_address(column("address1"), column("address2")).alias("address"),
        text("city").alias("city"),
        text("state").alias("state"),
        text("zipcode").alias("zip"),
        date("invoice_date").alias("invoice_date"),
        strip(column("invoice")).alias("invoice_num"),
        to_amount(column("ship_qty")).alias("qty"),
        to_amount(column("net_price")).alias("unit_price"),
        to_amount(column("total")).alias("total"),
    )
    return standard.withColumn("yyyymm", month_key(F.col("invoice_date"))).select(
        *STANDARD_COLUMNS
    )
