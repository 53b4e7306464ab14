"""The whole reporting run, from tagged sales to all report tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeledger.config import Config
from storeledger.functions.months import months_back
from storeledger.operators import payloads as forms
from storeledger.operators import quality
from storeledger.operators.cells import (
    FULL_GRAIN, MEASURES, PLACE, Audit, cells_and_places, observed_cells,
)
from storeledger.operators.locations import location_ref, one_per_location
from storeledger.operators.matching import apply_overrides, location_map, unmapped_locations
from storeledger.operators.metrics import (
    Period, in_months, last_columns, month_list, period, sku_month_list, sku_sales_3m,
)
from storeledger.operators.payloads import form_fields, form_payloads
from storeledger.operators.skus import apply_sku_aliases, canonical_description
from storeledger.operators.targets import (
    resolve_targets, sku_lines, target_skus, target_units, with_sku_sales,
)
from storeledger.plans import views
from storeledger.sources.customers import read_location_map
from storeledger.staging import materialise, shuffles_end


@dataclass(frozen=True)
class Run:
    cells: DataFrame
    location_map: DataFrame
    months: tuple[str, ...]
    period: Period
    config: Config
    audit: Audit | None = None

    @cached_property
    def descriptions(self) -> DataFrame:
        return materialise(canonical_description(self.cells), "descriptions")

    def sales_by_location_month(self) -> DataFrame:
        return views.sales_by_location_month(self.cells, self.location_map, self.months)

    def sales_by_sku_location_month(self) -> DataFrame:
        return views.sales_by_sku_location_month(
            self.cells, self.descriptions, self.location_map, self.sku_months
        )

    def qty_by_sku_location_month(self) -> DataFrame:
        return views.qty_by_sku_location_month(
            self.cells, self.descriptions, self.location_map, self.sku_months
        )

    def location_snapshot(self) -> DataFrame:
        return views.location_snapshot(self.cells, self.location_map, self.period, self.config)

    def top_skus(self) -> DataFrame:
        return views.top_skus(
            self.cells, self.descriptions, self.location_map, self.period, self.config
        )

    def sku_sales_3m(self) -> DataFrame:
        return sku_sales_3m(self.cells, self.sku_months)

    def sku_sales_sold(self) -> DataFrame:
        """``sku_sales_3m`` of the SKUs sold in these months, for reports that show 0 for all
        others: what a location sold before is not shuffled."""
        sold = self.cells.where(in_months(last_columns(self.sku_months)))
        return sku_sales_3m(sold, self.sku_months)

    @cached_property
    def sku_months(self) -> tuple[str, ...]:
        return tuple(sku_month_list(self.cells))

    def dedup_audit(self) -> DataFrame:
        return quality.dedup_audit(self.audit, self.cells.sparkSession)

    def profile(self) -> DataFrame:
        return quality.observed_profile(self.audit, self.cells)

    def views(self) -> dict[str, DataFrame]:
        """All five report tables, unevaluated."""
        return {
            "sales_by_location_month": self.sales_by_location_month(),
            "sales_by_sku_location_month": self.sales_by_sku_location_month(),
            "qty_by_sku_location_month": self.qty_by_sku_location_month(),
            "location_snapshot": self.location_snapshot(),
            "top_skus": self.top_skus(),
        }


def run(
    sales: DataFrame,
    crm: DataFrame | None,
    config: Config,
    saved_map: DataFrame | None = None,
    overrides: DataFrame | None = None,
    sku_aliases: DataFrame | None = None,
    grain: Sequence[str] = FULL_GRAIN,
    sku_months: Sequence[str] | None = None,
    measures: Sequence[str] = MEASURES,
) -> Run:
    """Prepare a run over the tagged, standardised union of all sources.

    The sales are read once. The location map is built unless one is given;
    customers set by hand in ``overrides`` win over matched ones. SKUs named in
    ``sku_aliases`` are renamed. A coarser ``grain`` does for a run that makes
    some of the reports only, and so do SKUs told apart in ``sku_months`` alone:
    the cells of other months are then sums over all SKUs, and ``measures`` that
    these reports show. The cells carry no places: those are counted beside them,
    for a map that is built.
    """
    if sku_months is not None:
        of_sku = F.when(in_months(sku_months), F.col("vendor_item"))
        sales = sales.withColumn("vendor_item", of_sku)
    if saved_map is None:
        cells, places, audit = cells_and_places(sales, grain, measures)
    else:
        placeless = [name for name in grain if name not in PLACE]
        cells, audit = observed_cells(sales, placeless, measures)
    if sku_aliases is not None:
        cells = apply_sku_aliases(cells, sku_aliases)
    if saved_map is None:
        mapped = location_map(location_ref(places), crm, config)
    else:
        mapped = one_per_location(saved_map)
    if overrides is not None:
        mapped = apply_overrides(mapped, overrides)
    mapped = materialise(mapped, "location-map")
    months = tuple(month_list(cells))
    return Run(cells, mapped, months, period(months, config), config, audit)


def snapshot_sku_months(config: Config) -> list[str] | None:
    """Months whose SKUs the snapshot tells apart; None while the report month is not known."""
    return config.report_month and months_back(config.report_month, 3)


def saved_or_built(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], reuse: bool = True
) -> DataFrame:
    """The location map saved at ``path``, or a new one that is saved there.

    A path that ends in ``.csv`` holds a table to edit by hand.
    """
    text = path.rstrip("/").endswith(".csv")

    def saved() -> DataFrame:
        return read_location_map(spark, path) if text else spark.read.parquet(path)

    if reuse:
        try:
            return saved()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    write_location_map(build(), path)
    return saved()


@dataclass(frozen=True)
class Forms:
    resolved: DataFrame
    fields: DataFrame
    payloads: DataFrame


def build_forms(
    targets: DataFrame,
    snapshot: DataFrame,
    top_skus: DataFrame,
    sku_sales: DataFrame,
    config: Config,
) -> Forms:
    """Payloads of all targets from the report tables."""
    resolved = materialise(resolve_targets(targets, snapshot), "resolved")
    listed = with_sku_sales(target_skus(resolved, top_skus, config), sku_sales)
    fields = form_fields(target_units(resolved, top_skus), sku_lines(listed))
    return Forms(resolved, fields, form_payloads(resolved, fields))


def run_forms(prepared: Run, targets: DataFrame) -> Forms:
    return build_forms(
        targets,
        prepared.location_snapshot(),
        materialise(prepared.top_skus(), "top-skus"),
        prepared.sku_sales_sold(),
        prepared.config,
    )


# --- Sinks --------------------------------------------------------------------


def write_views(tables: dict[str, DataFrame], folder: str) -> None:
    """Monthly tables as Parquet by report month, keeping the months already
    there; wide tables, whose columns change with the data, as compressed CSV: nearly all of
    their text are zeros of months without a sale."""
    for name, table in tables.items():
        target = f"{folder.rstrip('/')}/{name}"
        with shuffles_end(table.sparkSession):
            if "report_month" in table.columns:
                table.write.mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic"
                ).partitionBy("report_month").parquet(target)
            else:
                table.write.mode("overwrite").option("header", True).csv(
                    target, compression="gzip"
                )


def write_location_map(mapped: DataFrame, path: str, unmapped_path: str | None = None) -> int:
    """Write the map and, if there are any, the unmapped locations. Returns how
    many are unmapped."""
    mapped = materialise(mapped, "location-map")
    writer = mapped.write.mode("overwrite")
    if path.rstrip("/").endswith(".csv"):
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    unmapped = unmapped_locations(mapped)
    count = unmapped.count()
    if count and unmapped_path:
        unmapped.write.mode("overwrite").option("header", True).csv(unmapped_path)
    return count


def write_payloads(payloads: DataFrame, path: str, row_tag: str = "form") -> None:
    """Payloads as XML documents in bulk."""
    payloads.select(forms.xml_form().alias("form")).select("form.*").write.mode(
        "overwrite"
    ).format("xml").option("rowTag", row_tag).option("rootTag", f"{row_tag}s").save(path)


def delivered(spark: SparkSession, path: str, row_tag: str = "form") -> DataFrame:
    """The forms in a sink, with the columns of payloads and their ``report_month``."""
    schema = f"{forms.XML_SCHEMA}, report_month string"
    try:
        found = spark.read.schema(schema).format("xml").option("rowTag", row_tag).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        nothing = T.StructType.fromDDL(schema)  # without a data row, and without Python workers
        found = spark.range(0).select(
            *[F.lit(None).cast(field.dataType).alias(field.name) for field in nothing]
        )
    return found.select(*forms.from_xml_form(), "report_month")


DELIVERED, THERE, FAILED, SKIPPED = "delivered", "already there", "failed", "skipped"


def deliver(built: Forms, path: str, row_tag: str = "form") -> DataFrame:
    """Add the forms to a sink that does not hold them yet, as XML by report month.

    A form is known by its target and month. A run that was cut short may be repeated: what it
    has written stays, the rest is added, and a third run writes nothing. Returns ``target_ord,
    target_id, report_month, status`` of all targets, by what the sink held before and holds now:
    delivered, already there, failed (not in the sink), skipped (the target is unknown).

    Which targets lack a form is known from their keys, so forms are built for those only, and a
    sink that lacks none is not read again.
    """
    spark, keys = built.payloads.sparkSession, ["target_id", "report_month"]
    before = materialise(
        delivered(spark, path, row_tag).select(*keys).distinct(), "delivered-before"
    )
    lacking = materialise(
        built.resolved.where(F.col("key_kind").isNotNull()).join(before, keys, "left_anti")
        .select("target_ord", "report_month"),
        "lacking",
    )
    earlier = before.withColumn("earlier", F.lit(True))
    if lacking.isEmpty():
        now = earlier
    else:
        built.payloads.join(lacking, "target_ord").select(
            forms.xml_form().alias("form"), "report_month"
        ).select("form.*", "report_month").write.mode("append").partitionBy(
            "report_month"
        ).format("xml").option("rowTag", row_tag).option("rootTag", f"{row_tag}s").save(path)
        now = materialise(
            delivered(spark, path, row_tag).select(*keys).distinct().join(earlier, keys, "left"),
            "delivered-now",
        )
    now = now.withColumn("there", F.lit(True))
    status = (
        F.when(F.col("key_kind").isNull(), SKIPPED).when(F.col("earlier"), THERE)
        .when(F.col("there"), DELIVERED).otherwise(FAILED)
    )
    return built.resolved.join(now, keys, "left").select(
        "target_ord", *keys, status.alias("status")
    )
