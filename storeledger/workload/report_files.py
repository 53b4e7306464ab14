"""Distributor and chain reports as text files, to read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.sources.reports import REPORT_COLUMNS
from storeledger.staging import shuffles_end

SLICES = 2  # files of a month
# four title rows, then header cells as the report prints them
_TITLE = ("Monthly sales report", "", "Printed for,internal use", "")
_KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _month_and_slice() -> list[Column]:
    return [
        F.regexp_replace("sourcefile", "[^0-9-]", "").alias("month"),
        (F.btrim("invoice").cast("bigint") % SLICES).cast("int").alias("slice"),
    ]


def write_title_block_reports(raw: DataFrame, invoices: DataFrame, path: str) -> str:
    """A compressed file ``distributor_<month>_<slice>.csv.gz`` per month and slice of the invoices.

    ``invoices`` has the ``sourcefile`` and ``invoice`` of all lines, so the lines themselves are
    made once. A file whose invoices have no lines is a title block alone.
    """
    names = [name for name in REPORT_COLUMNS if name != "location"]
    header = ",".join(" ".join(n.capitalize() for n in name.split("_")) for name in names)
    lines = raw.select(
        *_month_and_slice(), F.lit(1).alias("place"),
        F.to_csv(F.struct(*names), _KEEP_BLANKS).alias("value"),
    )
    title = F.lit("\n".join((*_TITLE, header)))
    titles = invoices.select(*_month_and_slice()).distinct().select(
        "month", "slice", F.lit(0).alias("place"), title.alias("value")
    )
    with shuffles_end(raw.sparkSession):
        (
            titles.unionByName(lines)
            .repartition("month", "slice")
            .sortWithinPartitions("month", "slice", "place")
            .select("month", "slice", "value")
            .write.partitionBy("month", "slice")
            .option("zlib.compress.level", "BEST_SPEED")
            .text(path, compression="gzip")
        )
    _name_files(raw.sparkSession, path)
    return f"{path}/named/*.csv.gz"


def write_titled_export(table: DataFrame, order: str, path: str) -> str:
    """Two files with a title block, each in order, with the columns the other way round."""
    names = [f"`{c}`" for c in reversed(table.columns) if c != order]
    lines = table.select(
        (F.col(order) % SLICES).cast("int").alias("slice"), F.col(order).alias("place"),
        F.to_csv(F.struct(*names), _KEEP_BLANKS).alias("value"),
    )
    header = ",".join(name.strip("`") for name in names)
    titles = lines.select("slice").distinct().select(
        "slice", F.lit(None).cast("bigint").alias("place"),
        F.lit("\n".join(("Customers", "", "Exported for,somebody", "", header))).alias("value"),
    )
    (
        titles.unionByName(lines.withColumn("place", F.col("place").cast("bigint")))
        .repartition("slice")
        .sortWithinPartitions("slice", F.col("place").asc_nulls_first())
        .select("slice", "value")
        .write.partitionBy("slice")
        .text(path)
    )
    return f"{path}/slice=*"


def _name_files(spark, path: str) -> None:
    """Call each file by its month and slice, as a report is."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(hadoop.Path(f"{path}/named"))
    for found in files.globStatus(hadoop.Path(f"{path}/month=*/slice=*/part-*")):
        part = found.getPath()
        piece, month = part.getParent().getName(), part.getParent().getParent().getName()
        name = f"distributor_{month.split('=')[1]}_{piece.split('=')[1]}.csv.gz"
        files.rename(part, hadoop.Path(f"{path}/named/{name}"))


def write_table(raw: DataFrame, path: str) -> str:
    """A table with its header on the first row of every file."""
    raw.write.option("header", True).options(**_KEEP_BLANKS).csv(path)
    return path
