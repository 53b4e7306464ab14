"""Form fields and nested payloads, built for all targets at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.config import (
    FORM_API_NAME, FORM_FIELDS, FORM_NAME, FORM_STATUS, HOLDER_TYPE, TEXT_FIELD,
)
from storeledger.functions.numbers import fmt_money
from storeledger.functions.text import strip


def _field_type(api_name: Column) -> Column:
    entries = [F.lit(x) for name, (kind, _) in FORM_FIELDS.items() for x in (name, kind)]
    return F.coalesce(F.try_element_at(F.create_map(*entries), api_name), F.lit(TEXT_FIELD))


def _label(api_name: Column) -> Column:
    entries = [F.lit(x) for name, (_, label) in FORM_FIELDS.items() for x in (name, label)]
    return F.coalesce(F.try_element_at(F.create_map(*entries), api_name), api_name)


def form_fields(resolved_units: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per filled field of a target's form, in form order."""

    def field(position: int, name: str, value: Column) -> Column:
        return F.struct(
            F.lit(position).alias("position"), F.lit(name).alias("api_name"), value.alias("value")
        )

    sales = fmt_money(F.coalesce("last_month_total", F.lit(0.0)))
    summary = resolved_units.select(
        "target_ord",
        "target_id",
        F.inline(
            F.array(
                field(1, "ReportMonth", F.col("report_month")),
                field(2, "TotalSales", sales),
                field(3, "TotalUnits", F.col("total_units").cast("string")),
            )
        ),
    )
    skus = lines.select(
        "target_ord",
        "target_id",
        (F.col("position") + 3).alias("position"),
        F.concat(F.lit("TopSKU"), F.col("position").cast("string")).alias("api_name"),
        F.col("line").alias("value"),
    )
    value = strip(F.col("value"))
    return (
        summary.unionByName(skus)
        .where(value.isNotNull() & ~value.isin("", "nan"))
        .select(
            "target_ord",
            "target_id",
            "position",
            _field_type(F.col("api_name")).alias("field_type"),
            "api_name",
            F.lit(0).alias("index"),
            _label(F.col("api_name")).alias("name"),
            value.alias("value"),
        )
    )


def form_payloads(resolved: DataFrame, fields: DataFrame) -> DataFrame:
    """One nested payload per resolved target; a form has a few fields only."""
    field = F.struct("position", "field_type", "api_name", "index", "name", "value")
    gathered = fields.groupBy("target_ord").agg(F.sort_array(F.collect_list(field)).alias("f"))
    in_order = F.transform(
        "f",
        lambda x: F.struct(
            x["field_type"].alias("field_type"), x["api_name"].alias("api_name"),
            x["index"].alias("index"), x["name"].alias("name"), x["value"].alias("value"),
        ),
    )
    holder = F.col("crm_customer_id")
    return (
        resolved.where(F.col("key_kind").isNotNull())
        .join(gathered, "target_ord")
        .select(
            "target_ord",
            "target_id",
            holder.alias("holder_id"),
            F.when(holder.isNotNull(), F.lit(HOLDER_TYPE)).alias("holder_type"),
            F.lit(FORM_NAME).alias("name"),
            F.lit(FORM_API_NAME).alias("api_name"),
            F.lit(FORM_STATUS).alias("status"),
            in_order.alias("fields"),
        )
    )


def xml_form() -> Column:
    """A payload row in the element names and order of the form document."""
    fields = F.transform(
        "fields",
        lambda x: F.struct(
            x["field_type"].alias("fieldType"), x["api_name"].alias("apiName"),
            x["index"].alias("index"), x["name"].alias("name"), x["value"].alias("value"),
        ),
    )
    return F.struct(
        F.col("target_id").alias("filledFormId"),
        F.col("holder_id").alias("holderId"),
        F.col("holder_type").alias("holderType"),
        F.col("name"),
        F.col("api_name").alias("apiName"),
        F.col("status"),
        F.struct(fields.alias("formField")).alias("formFields"),
    )


# What ``xml_form`` writes.
XML_SCHEMA = (
    "filledFormId string, holderId string, holderType int, name string, apiName string,"
    " status string, formFields struct<formField: array<struct<fieldType: int, apiName: string,"
    " index: int, name: string, value: string>>>"
)


def from_xml_form() -> list[Column]:
    """The columns of a payload, from forms read back."""
    fields = F.transform(
        "formFields.formField",
        lambda x: F.struct(
            x["fieldType"].alias("field_type"), x["apiName"].alias("api_name"),
            x["index"].alias("index"), x["name"].alias("name"), x["value"].alias("value"),
        ),
    )
    return [
        F.col("filledFormId").alias("target_id"), F.col("holderId").alias("holder_id"),
        F.col("holderType").alias("holder_type"), F.col("name"),
        F.col("apiName").alias("api_name"), F.col("status"), fields.alias("fields"),
    ]


def form_xml(payloads: DataFrame, row_tag: str = "form") -> DataFrame:
    """``row_tag`` is the root element the receiver expects."""
    return payloads.select(
        "target_ord", "target_id", F.to_xml(xml_form(), {"rowTag": row_tag}).alias("xml")
    )


def delivery_status(resolved: DataFrame) -> DataFrame:
    """Targets ready for delivery and targets skipped as unknown."""
    status = F.when(F.col("key_kind").isNotNull(), "ready").otherwise("skipped")
    return resolved.groupBy(status.alias("status")).agg(F.count("*").alias("targets"))
