"""Report tables kept from run to run.

Monthly sums are stored in long form, a folder per month, and a run rewrites only the months
whose sums changed. The wide tables, whose columns are the months, are made when they are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.operators.metrics import MOST_MONTHS
from storeledger.plans import views
from storeledger.plans.run import Run
from storeledger.staging import materialise

BY_LOCATION, BY_SKU = "location_months", "sku_location_months"
LOCATIONS, DESCRIPTIONS = "locations", "descriptions"


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored long table; its months stay text."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    if "yyyymm" in found.columns:
        found = spark.read.schema(
            ", ".join(f"`{f.name}` {f.dataType.simpleString() if f.name != 'yyyymm' else 'string'}"
                      for f in found.schema.fields)
        ).parquet(path)
    return found


def _prints(long: DataFrame, name: str) -> DataFrame:
    """Rows of each month and the sum of their hashes: equal when the rows are."""
    columns = sorted(set(long.columns) - {"yyyymm"})
    row_hash = F.xxhash64(*columns).cast("decimal(38,0)")
    other = F.hash(*columns).cast("decimal(38,0)")
    return long.groupBy("yyyymm").agg(
        F.struct(F.count("*").alias("rows"), F.sum(row_hash).alias("h"),
                 F.sum(other).alias("g")).alias(name)
    )


def store_months(long: DataFrame, path: str) -> list[str]:
    """Bring a stored long table up to ``long``; returns the months that changed.

    Changed months are overwritten, months that ``long`` no longer has are removed, the files of
    all others are left as they are.
    """
    spark = long.sparkSession
    long = materialise(long, "months")
    stored = _stored(spark, path)
    ours = _prints(long, "ours")
    if stored is None:
        compared = ours.select("yyyymm", F.lit(True).alias("kept"))
    else:
        stored = stored.select([F.col(c).cast(long.schema[c].dataType) for c in long.columns])
        compared = (
            ours.join(_prints(stored, "theirs"), "yyyymm", "full_outer")
            .where(~F.col("ours").eqNullSafe(F.col("theirs")))
            .select("yyyymm", F.col("ours").isNotNull().alias("kept"))
        )
    changed = compared.limit(MOST_MONTHS + 1).collect()  # one row per changed month
    if len(changed) > MOST_MONTHS:
        raise ValueError(f"sales of more than {MOST_MONTHS} months")
    kept = sorted(r["yyyymm"] for r in changed if r["kept"])
    if kept:
        (
            long.where(F.col("yyyymm").isin(kept))
            .repartitionByRange("yyyymm", "location_code")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("yyyymm").parquet(path)
        )
    _remove(spark, [f"{path}/yyyymm={r['yyyymm']}" for r in changed if not r["kept"]])
    return sorted(r["yyyymm"] for r in changed)


def _remove(spark: SparkSession, folders: Sequence[str]) -> None:
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.delete(path, True)


SNAPSHOTS = ("location_snapshot", "top_skus")
WIDE = {  # table: the long table and the measure it is made of
    "sales_by_location_month": (BY_LOCATION, "total"),
    "sales_by_sku_location_month": (BY_SKU, "total"),
    "qty_by_sku_location_month": (BY_SKU, "qty"),
}


def store_report_tables(
    run: Run, folder: str, tables: Sequence[str] = (*WIDE, *SNAPSHOTS)
) -> dict[str, list[str]]:
    """Store what the report tables are made of: monthly sums by location and by SKU and
    location, the map of the locations, the descriptions, and the snapshot and the top SKUs of
    the run's report month. Returns the months of each long table that changed.

    Months that did not change and the snapshots of other report months are left as they are.
    """
    long = {WIDE[name][0] for name in tables if name in WIDE}
    changed = {}
    if BY_LOCATION in long:
        sums = views.sales_by_location_month_long(run.cells)
        changed[BY_LOCATION] = store_months(sums, f"{folder}/{BY_LOCATION}")
    if BY_SKU in long:
        sums = views.by_sku_location_month_long(run.cells)
        changed[BY_SKU] = store_months(sums, f"{folder}/{BY_SKU}")
        run.descriptions.write.mode("overwrite").parquet(f"{folder}/{DESCRIPTIONS}")
    if long:
        run.location_map.write.mode("overwrite").parquet(f"{folder}/{LOCATIONS}")
    for name in SNAPSHOTS:
        if name in tables:
            getattr(run, name)().write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("report_month").parquet(f"{folder}/{name}")
    return changed


def _months(long: DataFrame) -> list[str]:
    """Months of a stored table: the names of its folders, one row each."""
    return sorted(r["yyyymm"] for r in long.select("yyyymm").distinct().collect())


def read_report_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the five report tables, from what is stored."""
    if name in SNAPSHOTS:
        found = spark.read.parquet(f"{folder}/{name}")
        return found.withColumn("report_month", F.col("report_month").cast("string"))
    if name not in WIDE:
        raise ValueError(f"no report table {name}")
    kind, value = WIDE[name]
    long = _stored(spark, f"{folder}/{kind}")
    if long is None:
        raise FileNotFoundError(f"{name} is not stored in {folder}")
    locations = spark.read.parquet(f"{folder}/{LOCATIONS}")
    if kind == BY_LOCATION:
        return views.wide_by_location(long, locations, _months(long))
    descriptions = spark.read.parquet(f"{folder}/{DESCRIPTIONS}")
    return views.wide_by_sku_location(long, descriptions, locations, _months(long), value)
