"""CRM customers, targets, and tables whose ids must stay text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeledger.functions.text import clean_id, norm_key, numeric_id, strip
from storeledger.sources.titled import check_columns, read_titled, with_order
from storeledger.staging import materialise

# --- Fixed values: columns of the CRM export and the names used here ---
CRM_COLUMNS = {
    "Customer Name": "crm_customer_name",
    "Customer ID *": "crm_customer_id",
    "Location Name": "crm_location_name",
    "Street Address 1 *": "crm_address",
    "Street Address 2": "crm_address2",
    "City *": "crm_city",
    "State *": "crm_state",
    "Zip Code *": "crm_zip",
}

TARGET_REQUIRED = ("crm_customer_id", "target_id")
TARGET_OPTIONAL = ("customer_label", "location_code", "chain")


def crm_ref(export: DataFrame) -> DataFrame:
    """CRM export as customers with match keys; rows without a name are left out.

    ``ref_ord`` is the row's place in the export. It is taken from the input
    when present, because a table has no order of its own.
    """
    order = F.col("ref_ord") if "ref_ord" in export.columns else F.monotonically_increasing_id()
    kept = {raw: ours for raw, ours in CRM_COLUMNS.items() if raw in export.columns}
    named = export.select(
        order.cast("bigint").alias("ref_ord"),
        *[F.col(f"`{raw}`").cast("string").alias(ours) for raw, ours in kept.items()],
    ).dropna(subset=["crm_customer_name"])

    def key(name: str):
        return norm_key(F.col(name)) if name in named.columns else F.lit("")

    return named.withColumns(
        {
            "crm_customer_id": numeric_id(F.col("crm_customer_id")),
            "norm_name": key("crm_customer_name"),
            "norm_addr": key("crm_address"),
            "norm_loc": key("crm_location_name"),
        }
    )


def read_crm(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """CRM export with its title block, or a Parquet table. Rows keep the order of the file."""
    if path.rstrip("/").endswith(".parquet"):
        return materialise(crm_ref(spark.read.parquet(path)), "crm")
    export = read_titled(spark, path, tuple(CRM_COLUMNS), strip, multi_line=multi_line)
    return materialise(crm_ref(with_order(export, "ref_ord")), "crm")


def read_typed_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, *, multi_line: bool = True
) -> DataFrame:
    """CSV read by column name with given types, never inferred, so ids keep their text."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    raw = spark.read.csv(path, header=True, multiLine=multi_line)
    check_columns(raw, schema.names)
    return raw.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def read_location_map(spark: SparkSession, path: str) -> DataFrame:
    """A saved location map as CSV, edited by hand: of rows with the same code the first one."""
    columns = (
        "location_code", "chain", "customer_name", "address", "city", "state", "zip",
        "crm_customer_id", "crm_customer_name",
    )
    rows = with_order(read_titled(spark, path, columns, strip), "map_ord")
    first = F.min(F.struct("map_ord", *columns)).alias("first")
    kept = rows.where(F.col("location_code").isNotNull()).groupBy("location_code").agg(first)
    return kept.select(*[F.col(f"first.{c}") for c in columns])


def targets(raw: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Targets with trimmed, lower-case column names and cleaned ids.

    ``names`` renames columns of the list, after lower-casing, to the names
    used here. ``target_ord`` is a target's place in the list.
    """
    renamed = {**(names or {})}
    listed = raw.toDF(*[name.strip().lower() for name in raw.columns])
    listed = listed.withColumnsRenamed(renamed)
    check_columns(listed, TARGET_REQUIRED)
    if "target_ord" not in listed.columns:
        # numbered once: a second scan could number the rows in another way
        numbered = listed.withColumn("target_ord", F.monotonically_increasing_id())
        listed = materialise(numbered, "targets")
    location = strip(F.col("location_code")) if "location_code" in listed.columns else F.lit("")
    return listed.select(
        F.col("target_ord").cast("bigint").alias("target_ord"),
        clean_id(F.col("crm_customer_id")).alias("crm_customer_id"),
        strip(F.col("target_id")).alias("target_id"),
        *[
            (F.col(name).cast("string") if name in listed.columns else F.lit(None).cast("string"))
            .alias(name)
            for name in ("customer_label", "chain")
        ],
        F.when(~location.isin("", "nan"), location).alias("location_code"),
    )


def select_targets(listed: DataFrame, only: Sequence[str]) -> DataFrame:
    """Targets with a customer id, target id, label or location in ``only``."""
    wanted = sorted({text.strip().lower() for text in only})
    columns = ("crm_customer_id", "target_id", "customer_label", "location_code")
    matches = [F.coalesce(F.lower(strip(F.col(c))).isin(wanted), F.lit(False)) for c in columns]
    chosen = listed.where(matches[0] | matches[1] | matches[2] | matches[3])
    if chosen.isEmpty():
        raise ValueError("the selection matches no target")
    return chosen
