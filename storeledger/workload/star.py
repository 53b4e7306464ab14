"""Sales reports, CRM export and targets derived from the star-schema tables.

Every order line is a line of the distributor's report. Orders of AUTOMOBILE
and BUILDING customers appear a second time in the report of a chain, under a
name with a street number. The CRM knows customers with a balance of at least
0; how it writes their name and address depends on the region, so that every
matching rule has work to do. ``oracles.py`` states the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.config import CHAIN_A, CHAIN_B, DISTRIBUTOR, Config
from storeledger.operators.standardize import filter_detail, standardize
from storeledger.sources.customers import crm_ref, targets

CONFIG = Config(
    report_month="2001-07",
    tier_thresholds={"Tier 1": 50000.0, "Tier 2": 25000.0, "Tier 3": 10000.0},
    sku_variant_groups={
        "Widgets": ["red widget", "blue widget", "Old-Widget", "new widget"],
        "Hot goods": ["hot anvil", "hot bolt", "hot gear"],
        "Cold rod": None,
    },
)

SEGMENTS = {CHAIN_A: "AUTOMOBILE", CHAIN_B: "BUILDING"}
FEE_MONTH = "2001-08"  # the last month with orders: its lines are fees and name no SKU


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.parquet(path)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one by one: Spark takes nations joined with regions for a table larger than the customers
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn(
            "chain",
            F.when(F.col("c_mktsegment") == SEGMENTS[CHAIN_A], CHAIN_A).when(
                F.col("c_mktsegment") == SEGMENTS[CHAIN_B], CHAIN_B
            ),
        )
        .withColumn("brand", F.when(F.col("chain") == CHAIN_A, "LPQ").otherwise("JTJ"))
        .withColumn("street_no", F.expr("cast(100 + c_custkey % 9900 as string)"))
        .withColumn("street", F.expr("concat(c_custkey, ' ', n_name, ' Street')"))
    )


_INVOICE = "concat(' ', o_orderkey, ' ')"


def _sourcefile(source: Column | str) -> Column:
    month = F.date_format("o_orderdate", "yyyy-MM")
    return F.concat(source, F.lit("_"), month, F.lit(".csv")).alias("sourcefile")


def invoice_files(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """``invoice, sourcefile`` of all orders, as ``invoices`` names them for a source."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.expr(_INVOICE).alias("invoice"), _sourcefile(F.lit(source)))


def invoices(spark: SparkSession, sf_dir: str, sources: tuple[str, ...]) -> DataFrame:
    """Report columns that all lines of an order share, once per source."""
    buyers = customers(spark, sf_dir)
    if DISTRIBUTOR not in sources:
        buyers = buyers.where(F.col("c_mktsegment").isin([SEGMENTS[s] for s in sources]))
    reported_by = F.array(*[F.lit(DISTRIBUTOR)] * (DISTRIBUTOR in sources))
    if set(sources) - {DISTRIBUTOR}:
        reported_by = F.array_compact(F.concat(reported_by, F.array("chain")))
    by_chain = F.col("source") != DISTRIBUTOR
    code = F.expr("concat(' ', c_name, ' ')")
    name = (
        F.when(by_chain, F.expr("concat(brand, ' ', street_no, ' ', n_name)"))
        .when(F.col("r_name") == "MIDDLE EAST", F.expr("concat(c_name, ' Annex')"))
        .otherwise(F.col("c_name"))
    )
    return (
        table(spark, sf_dir, "orders")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("source", F.explode(reported_by))
        .select(
            "o_orderkey",
            "source",
            F.expr(_INVOICE).alias("invoice"),
            F.date_format(F.col("o_orderdate").cast("date"), "MM/dd/yy").alias("invoice_date"),
            F.when(by_chain, F.lit("HEAD OFFICE")).otherwise(code).alias("customer"),
            F.when(by_chain, code).alias("location"),
            name.alias("customer_name"),
            F.col("street").alias("address1"),
            F.expr("case when o_orderpriority <> '5-LOW' then r_name end").alias("address2"),
            F.col("n_name").alias("city"),
            F.expr("case when r_name <> 'ASIA' then r_name end").alias("state"),
            F.expr("lpad(cast(c_nationkey as string), 5, '0')").alias("zipcode"),
            _sourcefile("source"),
        )
    )


def report_lines(
    spark: SparkSession, sf_dir: str, sources: tuple[str, ...], items: bool = True
) -> DataFrame:
    """Raw report lines of the given sources, tagged with ``source``.

    One scan of the order lines serves all sources. ``items`` False leaves out
    the part table for reports without SKUs. Parts are joined first, while the
    lines are narrow: where the parts are too large to broadcast, this shuffles
    no text of the invoices.
    """
    lines = table(spark, sf_dir, "lineitem")
    if items:
        parts = table(spark, sf_dir, "part")
        lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    else:
        lines = lines.withColumns(
            {"p_name": F.lit(None).cast("string"), "p_type": F.lit(None).cast("string")}
        )
    lines = lines.join(
        invoices(spark, sf_dir, sources), F.col("l_orderkey") == F.col("o_orderkey")
    )
    is_fee = F.col("sourcefile").contains(FEE_MONTH)
    return lines.select(
        "source", "sourcefile", "invoice", "invoice_date", "customer", "location",
        "customer_name", "address1", "address2", "city", "state", "zipcode",
        F.when(~is_fee, F.col("p_name")).alias("vendor_item"),
        F.when(~is_fee, F.expr("concat(p_name, ' ', p_type)")).alias("item_description"),
        F.expr(
            "cast(case when cast(l_tax as decimal(4,2)) = 0.08 then -l_quantity"
            " else l_quantity end as decimal(12,2))"
        ).alias("ship_qty"),
        F.expr(
            "case l_linenumber when 7 then 'n/a' when 6 then null"
            " else cast(cast(l_extendedprice as decimal(12,2)) as string) end"
        ).alias("net_price"),
        F.expr(
            "cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(12,2)))"
        ).alias("total"),
        F.expr("case l_returnflag when 'R' then '2' when 'A' then '1.0' else '1' end").alias(
            "record_type"
        ),
    )


def tagged_sales(spark: SparkSession, sf_dir: str, items: bool = True) -> DataFrame:
    """Standardised union of all sources, before the dedup."""
    return tagged(report_lines(spark, sf_dir, (DISTRIBUTOR, CHAIN_A, CHAIN_B), items))


def tagged(raw: DataFrame) -> DataFrame:
    """``tagged_sales`` of report lines at hand."""
    by_chain = F.col("source") != DISTRIBUTOR
    location = F.when(by_chain, F.col("location")).otherwise(F.col("customer"))
    return standardize(filter_detail(raw), F.col("source"), location)


def chain_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised sales of the chains alone, without SKUs."""
    raw = report_lines(spark, sf_dir, (CHAIN_A, CHAIN_B), items=False)
    return standardize(filter_detail(raw), F.col("source"), "location")


def crm_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CRM export; customers with a balance above 9000 have a second row."""
    known = customers(spark, sf_dir).where("c_acctbal >= 0")
    copies = known.withColumn(
        "copy", F.explode(F.expr("if(c_acctbal > 9000, array(0, 1), array(1))"))
    )
    return copies.select(
        F.expr("c_custkey * 2 + copy").alias("ref_ord"),
        F.expr(
            """case when chain is not null and c_acctbal > 5000
                      then concat(brand, ' Bakery ', street_no)
                    when chain is not null then concat(brand, ' Bakery ', n_name)
                    when r_name = 'AFRICA' then replace(c_name, '#', ' - ')
                    when r_name = 'ASIA' then concat('The ', c_name, ' Store')
                    when r_name = 'MIDDLE EAST' then c_name
                    else concat('Account ', c_custkey) end"""
        ).alias("Customer Name"),
        F.expr(
            """case when c_mktsegment = 'FURNITURE' then concat(c_custkey, '.0')
                    when c_mktsegment = 'HOUSEHOLD' and r_name = 'AFRICA'
                      then cast(7000000000 + c_nationkey as string)
                    when c_mktsegment = 'HOUSEHOLD' and c_acctbal > 8000 then 'pending'
                    else cast(c_custkey as string) end"""
        ).alias("Customer ID *"),
        F.expr("case when chain is null and r_name = 'AMERICA' then lower(c_name) end").alias(
            "Location Name"
        ),
        F.expr(
            """case when copy = 0 then concat('PO Box ', c_custkey)
                    when chain is not null and c_acctbal > 5000 then 'Main Road'
                    when chain is not null then concat(street_no, ' Market Ave')
                    else concat(street, '; ', r_name) end"""
        ).alias("Street Address 1 *"),
        F.col("n_name").alias("City *"),
    )


def crm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crm_ref(crm_export(spark, sf_dir))


def target_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One target per customer. FURNITURE and shared accounts name no location,
    HOUSEHOLD customers with a debt name a location that is closed."""
    return customers(spark, sf_dir).select(
        F.expr(
            """case when c_mktsegment = 'FURNITURE' then concat(c_custkey, '.0')
                    when c_mktsegment = 'HOUSEHOLD' and r_name = 'AFRICA'
                      then cast(7000000000 + c_nationkey as string)
                    else cast(c_custkey as string) end"""
        ).alias(" CRM_Customer_ID "),
        F.expr("cast(100000000 + c_custkey as string)").alias("Target_ID"),
        F.col("c_name").alias("customer_label"),
        F.expr(
            """case when c_mktsegment = 'FURNITURE' then ' '
                    when c_mktsegment = 'HOUSEHOLD' and r_name = 'AFRICA' then ''
                    when c_mktsegment = 'HOUSEHOLD' and c_acctbal < 0 then concat('CLOSED ', c_name)
                    else c_name end"""
        ).alias("Location_Code"),
        F.coalesce("chain", F.lit(DISTRIBUTOR)).alias("chain"),
        F.col("c_custkey").alias("target_ord"),
    )


def all_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return targets(target_list(spark, sf_dir))


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-made links for customers that the CRM export lacks."""
    return customers(spark, sf_dir).where("c_acctbal < 0").select(
        F.expr("lower(replace(c_name, '#', '-'))").alias("excel_customer"),
        F.expr("concat(street, ' / ', r_name)").alias("excel_shipto"),
        F.expr("cast(80000000 + c_custkey as string)").alias("crm_customer_id"),
        F.expr("concat('Manual ', c_name)").alias("crm_customer_name"),
    )


def sku_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Red parts were renamed."""
    return (
        table(spark, sf_dir, "part")
        .where(F.col("p_name").startswith("red "))
        .select(F.col("p_name").alias("excel_sku"))
        .distinct()
        .withColumn("mapped_sku", F.concat(F.lit("crimson"), F.expr("substring(excel_sku, 4)")))
    )
