"""Registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.config import AUTHORITATIVE, CHAIN_A, CHAIN_B, DISTRIBUTOR
from storeledger.functions import months as month_fns
from storeledger.functions import numbers, text
from storeledger.functions.tiers import sla_tier, visit_frequency
from storeledger.operators import (
    cells as cell_ops, locations, matching, metrics, payloads, quality, skus, targets, unify,
)
from storeledger.operators.standardize import filter_detail
from storeledger.plans import run as runs
from storeledger.plans import store, views
from storeledger.sources import customers, reports
from storeledger.staging import staging_path
from storeledger.workload import report_files, star

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}
CONFIG = star.CONFIG
# the snapshot shows SKUs but no descriptions
SNAPSHOT_GRAIN = tuple(c for c in cell_ops.FULL_GRAIN if c != "item_description")
# totals are compared by SKU, whatever its descriptions
TOTALS_GRAIN = tuple(c for c in cell_ops.SKU_GRAIN if c != "item_description")


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__.removesuffix("_table")] = fn
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


def _cells(spark, sf, grain=cell_ops.SKU_GRAIN) -> DataFrame:
    sales = star.tagged_sales(spark, sf, "vendor_item" in grain)
    return cell_ops.sales_cells(sales, grain)


def _period(cells: DataFrame) -> metrics.Period:
    return metrics.period(metrics.month_list(cells), CONFIG)


def _run(spark, sf, grain=cell_ops.FULL_GRAIN) -> runs.Run:
    sales = star.tagged_sales(spark, sf, "vendor_item" in grain)
    sku_months = runs.snapshot_sku_months(CONFIG) if grain == SNAPSHOT_GRAIN else None
    # by location and month alone, the reports show sales and no quantities
    measures = ("total",) if grain == cell_ops.LOCATION_PLACE_GRAIN else cell_ops.MEASURES
    return runs.run(
        sales, star.crm(spark, sf), CONFIG, grain=grain, sku_months=sku_months, measures=measures
    )


def _forms(spark, sf) -> runs.Forms:
    return runs.run_forms(_run(spark, sf), star.all_targets(spark, sf))


def _resolved(spark, sf) -> DataFrame:
    snapshot = location_snapshot(spark, sf)
    return targets.resolve_targets(star.all_targets(spark, sf), snapshot)


def _keyed(spark, sf) -> DataFrame:
    grain = ("source", "location_code", *cell_ops.PLACE)
    refs = locations.location_ref(_cells(spark, sf, grain))
    return runs.materialise(matching.with_keys(refs), "locations")


def _crm(spark, sf) -> DataFrame:
    return runs.materialise(star.crm(spark, sf), "crm")


def _matched(hits: DataFrame, crm: DataFrame) -> DataFrame:
    return matching.with_customer(hits, crm).select(
        "location_code", "crm_customer_id", "crm_customer_name"
    )


# --- Scans --------------------------------------------------------------------


def _read_reports(spark, sf) -> DataFrame:
    raw = star.report_lines(spark, sf, (DISTRIBUTOR,))
    files = star.invoice_files(spark, sf, DISTRIBUTOR)
    path = report_files.write_title_block_reports(raw, files, staging_path(spark, "reports"))
    return reports.read_reports(spark, path, multi_line=False)


@query
def scan_reports(spark, sf):
    return as_double(
        _read_reports(spark, sf).select(
            "sourcefile", "vendor_item", "item_description",
            text.strip(F.col("invoice")).alias("invoice"), "invoice_date",
            text.strip(F.col("customer")).alias("customer"), "customer_name", "address1",
            "address2", "city", "state", "zipcode", "ship_qty", "net_price", "total",
            "record_type",
        ),
        "ship_qty", "total",
    )


def _scan_chain(spark, sf, source, standard) -> DataFrame:
    raw = star.report_lines(spark, sf, (source,)).drop("source", "sourcefile")
    path = report_files.write_table(raw, staging_path(spark, "chain"))
    sales = standard(reports.read_table(spark, path, multi_line=False))
    return as_double(sales, "qty", "unit_price", "total")


@query
def scan_chain_a(spark, sf):
    return _scan_chain(spark, sf, CHAIN_A, reports.chain_a_sales)


@query
def scan_chain_b(spark, sf):
    return _scan_chain(spark, sf, CHAIN_B, reports.chain_b_sales)


@query
def crm_ref(spark, sf):
    export = star.crm_export(spark, sf)
    path = report_files.write_titled_export(export, "ref_ord", staging_path(spark, "crm-export"))
    read = customers.read_crm(spark, path, multi_line=False)
    return read.drop("crm_address2", "crm_state", "crm_zip")  # not in this export


@query
def scan_typed_csv(spark, sf):
    path = staging_path(spark, "overrides")
    table = star.overrides(spark, sf)
    table.select(*reversed(table.columns)).write.option("header", True).csv(path)
    return customers.read_typed_csv(spark, path, table.schema, multi_line=False)


@query
def targets_table(spark, sf):
    return star.all_targets(spark, sf)


# --- Columns and expressions --------------------------------------------------


@query
def normalize_header(spark, sf):
    header = F.expr("concat('# ', p_brand, '\\n', p_type, ' (', p_name, ')')")
    parts = star.table(spark, sf, "part")
    return parts.select("p_partkey", text.normalize_header(header).alias("header"))


@query
def standardize(spark, sf):
    raw = star.report_lines(spark, sf, (DISTRIBUTOR,))
    return as_double(reports.distributor_sales(raw), "qty", "unit_price", "total")


@query
def coerce_numeric(spark, sf):
    raw = F.expr(
        """case o_orderpriority when '1-URGENT' then cast(cast(o_totalprice as decimal(12,2)) as string)
             when '2-HIGH' then concat(' ', cast(o_orderkey as string), '.5 ')
             when '3-MEDIUM' then concat(cast(o_orderkey as string), 'D')
             when '4-NOT SPECIFIED' then format_number(o_totalprice + 1000, 2) end"""
    )
    orders = star.table(spark, sf, "orders")
    return orders.select(
        "o_orderkey", numbers.to_amount(raw).cast("double").alias("amount")
    )


@query
def coerce_ids(spark, sf):
    raw = F.expr("concat('\\t ', o_custkey, '-', o_orderkey, '  ')")
    orders = star.table(spark, sf, "orders")
    return orders.select("o_orderkey", text.strip(raw).alias("id"))


@query
def parse_month(spark, sf):
    raw = F.expr(
        """case o_orderpriority when '5-LOW' then date_format(o_orderdate, 'yyyy-MM-dd')
             when '1-URGENT' then date_format(o_orderdate, 'M/d/yy')
             else date_format(o_orderdate, 'MM/dd/yy') end"""
    )
    date = month_fns.parse_report_date(raw)
    return star.table(spark, sf, "orders").select(
        "o_orderkey", date.alias("invoice_date"), month_fns.month_key(date).alias("yyyymm")
    )


@query
def concat_address(spark, sf):
    line1 = F.expr("case when c_acctbal > 8000 then 'NaN' else street end")
    line2 = F.expr("case when c_acctbal < 0 then '  ' when c_acctbal < 5000 then r_name end")
    return star.customers(spark, sf).select(
        "c_custkey", text.concat_address(line1, line2).alias("address")
    )


@query
def norm_key(spark, sf):
    documents = star.table(spark, sf, "documents")
    return documents.select("doc_id", text.norm_key(F.col("text")).alias("match_key"))


@query
def clean_id(spark, sf):
    raw = F.col("`Customer ID *`")
    return star.crm_export(spark, sf).select(
        "ref_ord", text.clean_id(raw).alias("id"), text.numeric_id(raw).alias("numeric_id")
    )


@query
def street_numbers(spark, sf):
    found = text.street_numbers(text.norm_key(F.col("text")))
    documents = star.table(spark, sf, "documents")
    return documents.select("doc_id", F.array_join(found, ",").alias("street_numbers"))


@query
def fmt_money(spark, sf):
    value = F.expr("o_totalprice - 250000")
    return star.table(spark, sf, "orders").select(
        "o_orderkey", numbers.fmt_money(value).alias("shown")
    )


@query
def fmt_qty(spark, sf):
    value = F.expr("case when o_orderstatus <> 'P' then o_totalprice / 2 end")
    return star.table(spark, sf, "orders").select(
        "o_orderkey", numbers.fmt_qty(value).alias("shown")
    )


@query
def month_window(spark, sf):
    month = month_fns.month_key(F.col("o_orderdate"))
    months = F.array_join(month_fns.trailing_months(month, 6), ",")
    return star.table(spark, sf, "orders").select("o_orderkey", months.alias("months"))


# --- Filters, union, dedup ----------------------------------------------------


@query
def filter_detail_table(spark, sf):
    raw = star.report_lines(spark, sf, (DISTRIBUTOR,), items=False)
    return as_double(
        filter_detail(raw).select(
            text.strip(F.col("invoice")).alias("invoice"), "record_type", "ship_qty", "total"
        ),
        "ship_qty", "total",
    )


@query
def filter_trailing(spark, sf):
    sales = star.tagged_sales(spark, sf)
    recent = sales.where(metrics.in_months(month_fns.months_back(CONFIG.report_month, 3)))
    kept = recent.select("source", "location_code", "vendor_item", "yyyymm", "qty", "total")
    return as_double(kept, "qty", "total")


@query
def chain_codes(spark, sf):
    return unify.chain_codes(star.chain_sales(spark, sf))


@query
def precedence_dedup(spark, sf):
    cells = _cells(spark, sf, ("source", "location_code"))
    return as_double(cells.drop("lines"), "total", "qty")


@query
def unified_sales(spark, sf):
    sales = unify.unified(star.tagged_sales(spark, sf))
    return as_double(sales, "qty", "unit_price", "total")


@query
def dedup_audit(spark, sf):
    sales = star.tagged_sales(spark, sf, items=False)
    _, audit = cell_ops.observed_cells(sales, cell_ops.LOCATION_GRAIN)
    return quality.dedup_audit(audit, spark)


@query
def file_row_counts(spark, sf):
    return reports.file_row_counts(_read_reports(spark, sf))


@query
def distinct_locations(spark, sf):
    return quality.distinct_locations(_cells(spark, sf, ("source", "location_code")))


@query
def run_profile(spark, sf):
    sales = star.tagged_sales(spark, sf, items=False)
    cells, audit = cell_ops.observed_cells(sales, cell_ops.LOCATION_GRAIN)
    return quality.observed_profile(audit, cells)


@query
def reconcile_invoices(spark, sf):
    return quality.reconcile_invoices(star.tagged_sales(spark, sf, items=False))


def _compared(spark, sf) -> DataFrame:
    # both sides read the report lines; written, they are joined once
    lines = star.report_lines(spark, sf, (DISTRIBUTOR, *AUTHORITATIVE)).select(
        "source", "customer", "location", "invoice_date", "vendor_item", "ship_qty", "total",
        "record_type",
    )
    raw = runs.materialise(lines, "report-lines")
    cells = cell_ops.cells_read_once(star.tagged(raw), TOTALS_GRAIN)
    # the chains' own totals, straight from their order lines, refunds included
    date = month_fns.parse_report_date(F.col("invoice_date"))
    expected = raw.where(F.col("source").isin(*AUTHORITATIVE)).select(
        text.strip(F.col("location")).alias("location_code"), "vendor_item",
        month_fns.month_key(date).alias("yyyymm"), "total", F.col("ship_qty").alias("qty"),
    )
    return quality.reconcile_totals(cells, expected)


@query
def reconcile_totals(spark, sf):
    return as_double(_compared(spark, sf), "view_value", "expected_value")


@query
def reconciliation_summary(spark, sf):
    summary = quality.reconciliation_summary(_compared(spark, sf))
    return as_double(summary, "view_value", "expected_value")


# --- SKUs ---------------------------------------------------------------------


@query
def canonical_description(spark, sf):
    return skus.canonical_description(_cells(spark, sf))


@query
def sku_variant_group(spark, sf):
    parts = star.table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("vendor_item"))
    return skus.variant_groups(parts, CONFIG)


@query
def sku_alias(spark, sf):
    lines = star.table(spark, sf, "lineitem").join(
        star.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    sold = lines.select("l_orderkey", "l_linenumber", F.col("p_name").alias("vendor_item"))
    return skus.apply_sku_aliases(sold, star.sku_aliases(spark, sf))


# --- Metrics ------------------------------------------------------------------


@query
def report_month(spark, sf):
    return metrics.latest_month(_cells(spark, sf, cell_ops.LOCATION_GRAIN))


@query
def active_months(spark, sf):
    cells = _cells(spark, sf, cell_ops.LOCATION_GRAIN)
    return metrics.active_months(cells, CONFIG.report_month)


@query
def active_month_list(spark, sf):
    cells = _cells(spark, sf, cell_ops.LOCATION_GRAIN)
    return metrics.active_month_list(cells, CONFIG.report_month)


@query
def rolling_sales(spark, sf):
    cells = _cells(spark, sf, cell_ops.LOCATION_GRAIN)
    return metrics.rolling_sales(cells, _period(cells))


@query
def sla_tier_table(spark, sf):
    cells = _cells(spark, sf, cell_ops.LOCATION_GRAIN)
    sales = metrics.rolling_sales(cells, _period(cells)).select(
        "location_code", sla_tier(F.col("avg_monthly_3m"), CONFIG).alias("sla_tier")
    )
    return sales.withColumn("visit_frequency", visit_frequency(F.col("sla_tier"), CONFIG))


@query
def rolling_qty(spark, sf):
    cells = _cells(spark, sf)
    return metrics.rolling_qty(cells, _period(cells))


@query
def sku_group_qty(spark, sf):
    cells = _cells(spark, sf)
    return metrics.sku_group_qty(cells, _period(cells), CONFIG)


@query
def most_popular_sku(spark, sf):
    cells = _cells(spark, sf)
    return metrics.most_popular_sku(metrics.sku_group_qty(cells, _period(cells), CONFIG))


@query
def sku_sales_3m(spark, sf):
    cells = _cells(spark, sf)
    return metrics.sku_sales_3m(cells, metrics.sku_month_list(cells))


# --- Locations and matching ---------------------------------------------------


@query
def location_ref(spark, sf):
    grain = ("source", "location_code", *cell_ops.PLACE)
    return locations.location_ref(_cells(spark, sf, grain))


@query
def match_exact_name(spark, sf):
    crm = _crm(spark, sf)
    return _matched(matching.match_exact_name(_keyed(spark, sf), crm), crm)


@query
def match_location_name(spark, sf):
    crm = _crm(spark, sf)
    return _matched(matching.match_location_name(_keyed(spark, sf), crm), crm)


@query
def match_contains(spark, sf):
    crm = _crm(spark, sf)
    return _matched(matching.match_contains(_keyed(spark, sf), crm), crm)


@query
def match_contained_by(spark, sf):
    crm = _crm(spark, sf)
    return _matched(matching.match_contained_by(_keyed(spark, sf), crm), crm)


@query
def match_address(spark, sf):
    crm = _crm(spark, sf)
    return _matched(matching.match_address(_keyed(spark, sf), crm), crm)


@query
def match_street_number(spark, sf):
    crm = _crm(spark, sf)
    return _matched(matching.match_street_number(_keyed(spark, sf), crm, CONFIG), crm)


@query
def location_map(spark, sf):
    grain = ("source", "location_code", *cell_ops.PLACE)
    refs = locations.location_ref(_cells(spark, sf, grain))
    return matching.location_map(refs, star.crm(spark, sf), CONFIG)


@query
def unmapped_locations(spark, sf):
    return matching.unmapped_locations(location_map(spark, sf))


@query
def mapping_coverage(spark, sf):
    return quality.mapping_coverage(location_map(spark, sf))


@query
def customer_override(spark, sf):
    return matching.apply_overrides(location_map(spark, sf), star.overrides(spark, sf))


@query
def unused_overrides(spark, sf):
    grain = ("source", "location_code", *cell_ops.PLACE)
    refs = locations.location_ref(_cells(spark, sf, grain))
    return matching.unused_overrides(refs, star.overrides(spark, sf))


# --- Report tables ------------------------------------------------------------


@query
def sales_by_location_month_long(spark, sf):
    cells = _cells(spark, sf, cell_ops.LOCATION_GRAIN)
    return as_double(views.sales_by_location_month_long(cells), "total")


@query
def sales_by_sku_location_month_long(spark, sf):
    long = views.by_sku_location_month_long(_cells(spark, sf))
    return as_double(long.drop("qty"), "total")


@query
def qty_by_sku_location_month_long(spark, sf):
    long = views.by_sku_location_month_long(_cells(spark, sf))
    return as_double(long.drop("total"), "qty")


@query
def enrich_locations(spark, sf):
    run = _run(spark, sf, cell_ops.LOCATION_PLACE_GRAIN)
    long = views.sales_by_location_month_long(run.cells)
    return as_double(locations.enrich(long, run.location_map), "total")


@query
def sales_by_location_month(spark, sf):
    return _run(spark, sf, cell_ops.LOCATION_PLACE_GRAIN).sales_by_location_month()


@query
def sales_by_sku_location_month(spark, sf):
    return _run(spark, sf).sales_by_sku_location_month()


@query
def qty_by_sku_location_month(spark, sf):
    return _run(spark, sf).qty_by_sku_location_month()


@query
def location_snapshot(spark, sf):
    return _run(spark, sf, SNAPSHOT_GRAIN).location_snapshot()


@query
def top_skus(spark, sf):
    return _run(spark, sf).top_skus()


@query
def tier_distribution(spark, sf):
    return quality.tier_distribution(location_snapshot(spark, sf))


# --- Targets and payloads -----------------------------------------------------


@query
def select_targets(spark, sf):
    chosen = ["customer#000000007", "100000011", "23.0", " 42 ", "no such target"]
    return customers.select_targets(star.all_targets(spark, sf), chosen)


@query
def resolve_targets(spark, sf):
    return _resolved(spark, sf)


@query
def unresolved_targets(spark, sf):
    return targets.unresolved_targets(_resolved(spark, sf))


@query
def delivery_status(spark, sf):
    return payloads.delivery_status(_resolved(spark, sf))


def _target_tables(spark, sf):
    run = _run(spark, sf)
    top = runs.materialise(run.top_skus(), "top-skus")
    resolved = targets.resolve_targets(star.all_targets(spark, sf), run.location_snapshot())
    return run, runs.materialise(resolved, "resolved"), top


@query
def target_skus(spark, sf):
    _, resolved, top = _target_tables(spark, sf)
    return targets.target_skus(resolved, top, CONFIG)


@query
def target_sku_rank(spark, sf):
    _, resolved, top = _target_tables(spark, sf)
    return targets.target_skus(resolved, top, CONFIG).select(
        "target_ord", "target_id", "vendor_item", "position"
    )


@query
def target_units(spark, sf):
    _, resolved, top = _target_tables(spark, sf)
    return targets.target_units(resolved, top).select(
        "target_ord", "target_id", "key_kind", "key", "total_units", "sku_rows"
    )


@query
def target_sku_sales(spark, sf):
    run, resolved, top = _target_tables(spark, sf)
    listed = targets.target_skus(resolved, top, CONFIG)
    priced = targets.with_sku_sales(listed, run.sku_sales_sold())
    return priced.select("target_ord", "target_id", "position", "vendor_item", "avg_sales_3m")


@query
def sku_lines(spark, sf):
    run, resolved, top = _target_tables(spark, sf)
    listed = targets.target_skus(resolved, top, CONFIG)
    priced = targets.with_sku_sales(listed, run.sku_sales_sold())
    return targets.sku_lines(priced)


@query
def form_fields(spark, sf):
    return _forms(spark, sf).fields


@query
def form_payloads(spark, sf):
    return _forms(spark, sf).payloads.withColumn("fields", F.to_json("fields"))


@query
def form_xml(spark, sf):
    return payloads.form_xml(_forms(spark, sf).payloads)


# --- Sinks, written and read back ---------------------------------------------


def _written_views(spark, sf) -> str:
    folder = staging_path(spark, "report-tables")
    runs.write_views(_run(spark, sf).views(), folder)
    return folder


@query
def written_report_tables(spark, sf):
    """Rows and sums of all five report tables, as written."""
    folder = _written_views(spark, sf)
    parts = []
    for name in ("location_snapshot", "top_skus"):
        measure = "last_month_total" if name == "location_snapshot" else "last_month_qty"
        table = spark.read.parquet(f"{folder}/{name}")
        parts.append((name, table, F.sum(F.col(measure).cast("decimal(28,4)"))))
    for name in (
        "sales_by_location_month", "sales_by_sku_location_month", "qty_by_sku_location_month"
    ):
        table = spark.read.csv(f"{folder}/{name}", header=True)
        month = F.col(f"`{CONFIG.report_month}`").cast("decimal(28,4)")
        parts.append((name, table, F.sum(month)))
    summed = [
        table.agg(
            F.lit(name).alias("table_name"), F.count("*").alias("rows"),
            F.countDistinct("location_code").alias("locations"),
            total.cast("double").alias("month_total"),
        )
        for name, table, total in parts
    ]
    return reduce(DataFrame.unionByName, summed)


@query
def written_location_map(spark, sf):
    """The map saved as a table to edit by hand, and read again in place of a new one."""
    path = staging_path(spark, "location-map") + ".csv"
    runs.saved_or_built(spark, path, lambda: location_map(spark, sf))
    saved = runs.saved_or_built(spark, path, lambda: location_map(spark, sf))
    # text files do not tell empty from missing
    return saved.withColumns({c: F.coalesce(c, F.lit("")) for c in saved.columns})


@query
def written_unmapped_locations(spark, sf):
    path = staging_path(spark, "location-map")
    runs.write_location_map(location_map(spark, sf), path, f"{path}-unmapped")
    return spark.read.csv(f"{path}-unmapped", header=True).select("location_code", "chain")


@query
def written_payloads(spark, sf):
    """Payloads delivered twice, of which the second run adds nothing, and read back."""
    path = staging_path(spark, "payloads")
    forms = _forms(spark, sf)
    for _ in range(2):
        runs.deliver(forms, path)
    read = runs.delivered(spark, path).drop("report_month")
    return read.withColumn("fields", F.to_json("fields"))


@query
def delivery_results(spark, sf):
    """Targets by what became of them, in a first and in a second delivery."""
    path = staging_path(spark, "payloads")
    forms = _forms(spark, sf)
    counted = [
        runs.deliver(forms, path).groupBy("status").agg(F.count("*").alias("targets"))
        .withColumn("run", F.lit(run))
        for run in (1, 2)
    ]
    return runs.materialise(reduce(DataFrame.unionByName, counted), "delivery-results")


def _stored_table(spark, sf, name, grain=cell_ops.FULL_GRAIN) -> DataFrame:
    """A report table stored twice, of which the second time changes no month, and read back."""
    folder, run = staging_path(spark, "report-store"), _run(spark, sf, grain)
    store.store_report_tables(run, folder, [name])
    again = store.store_report_tables(run, folder, [name])
    if any(again.values()):
        raise ValueError(f"stored months changed without a change: {again}")
    return store.read_report_table(spark, folder, name)


@query
def stored_sales_by_location_month(spark, sf):
    grain = cell_ops.LOCATION_PLACE_GRAIN
    return _stored_table(spark, sf, "sales_by_location_month", grain)


@query
def stored_sales_by_sku_location_month(spark, sf):
    return _stored_table(spark, sf, "sales_by_sku_location_month")


@query
def stored_qty_by_sku_location_month(spark, sf):
    return _stored_table(spark, sf, "qty_by_sku_location_month")


@query
def stored_location_snapshot(spark, sf):
    return _stored_table(spark, sf, "location_snapshot", SNAPSHOT_GRAIN)


@query
def stored_top_skus(spark, sf):
    return _stored_table(spark, sf, "top_skus")
