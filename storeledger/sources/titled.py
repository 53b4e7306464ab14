"""Text files that open with a title block: rows, their order, and the header found by name."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeledger.staging import materialise

_FIRST_WIDTH = 64
HEADER_MATCHES = 3  # known names that make a row the header


def check_columns(df: DataFrame, required: Sequence[str]) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


_COMPRESSED = (".bz2", ".deflate", ".gz", ".lz4", ".snappy", ".zst")


def _name_without(endings: Sequence[str]) -> Column:
    name = F.col("_metadata.file_name")
    plain = [
        F.when(F.endswith(name, F.lit(end)), F.left(name, F.length(name) - len(end)))
        for end in endings
    ]
    return F.coalesce(*plain, name)


def _file() -> list[Column]:
    """A row's file and its place there, to be taken and stored in one scan: blocks of a file
    are read in any order, the rows of a block in file order. A compressed file goes by the name
    of what it holds."""
    return [
        F.col("_metadata.file_path").alias("file"),
        _name_without(_COMPRESSED).alias("sourcefile"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ]


def _read_cells(spark: SparkSession, paths: list[str], multi_line: bool, width: int) -> DataFrame:
    """All rows as lists of cells; ``wider`` marks rows with more cells than that."""
    cells = [f"_c{i}" for i in range(width)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*cells, "_other_width"]])
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", "_other_width")
        .csv(paths)
        .select(
            *_file(), F.array(*cells).alias("cells"),
            # Spark marks shorter rows too, and those have no last cell
            (F.col("_other_width").isNotNull() & F.col(cells[-1]).isNotNull()).alias("wider"),
        )
    )


def stored_cells(
    spark: SparkSession, path: str | Sequence[str], multi_line: bool = True
) -> DataFrame:
    """``file, sourcefile, block, row, cells`` of all files, written once.

    The place of a row is stored with it, so it stays the same however later scans are split.
    Files with rows wider than expected are read again with more cells.
    """
    paths, width = [path] if isinstance(path, str) else list(path), _FIRST_WIDTH
    while True:
        rows = _read_cells(spark, paths, multi_line, width)
        if not rows.inputFiles():
            raise FileNotFoundError(f"no files at {path}")
        stored = materialise(rows, "cells-of-files")
        if stored.where("wider").isEmpty():
            return stored.drop("wider")
        width *= 4


# A line with a quoted cell that goes on in the next line; a quote counts where a cell begins.
_OPEN_CELL = r'^(?:(?:"(?:[^"]|"")*+"[^,]*+|[^",][^,]*+)?,)*+"(?:[^"]|"")*+\z'
_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*\z)'  # outside quotes
_TITLE_LINES = (256, 65_536)  # where a header is looked for, first and at last


def stored_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file, sourcefile, block, row, value`` of all lines, written once.

    The files are split, and each line is stored with its place. What is found in the first
    lines of a file then holds for all later reads, however they are split, and those read
    compressed columns in place of the text.
    """
    rows = spark.read.text([path] if isinstance(path, str) else list(path)).select(
        *_file(), "value"
    )
    if not rows.inputFiles():
        raise FileNotFoundError(f"no files at {path}")
    return materialise(rows, "lines-of-files")


def _records(lines: Column) -> Column:
    """CSV records of (row, value) lines: their text, and the row of their last line."""
    nothing = F.lit(None).cast("string")

    def add(found: Column, line: Column) -> Column:
        text = F.when(found["open"].isNull(), line["value"]).otherwise(
            F.concat(found["open"], F.lit("\n"), line["value"])
        )
        ended = F.array_append(found["done"], F.struct(text.alias("text"), line["row"].alias("end")))
        goes_on = text.rlike(_OPEN_CELL)
        return F.struct(
            F.when(goes_on, found["done"]).otherwise(ended).alias("done"),
            F.when(goes_on, text).alias("open"),
        )

    none = F.array().cast("array<struct<text:string,end:bigint>>")
    start = F.struct(none.alias("done"), nothing.alias("open"))
    return F.aggregate(lines, start, add, lambda found: found["done"])


def _cells(record: Column) -> Column:
    def bare(cell: Column) -> Column:
        inside = F.regexp_extract(cell, r'(?s)^\s*"(.*)"\s*\z', 1)
        return F.when(
            cell.rlike(r'(?s)^\s*".*"\s*\z'), F.replace(inside, F.lit('""'), F.lit('"'))
        ).otherwise(cell)

    return F.transform(F.split(record, _COMMA, -1), bare)


def _headers(
    lines: DataFrame, starts: DataFrame, known: Column, name: Callable[[Column], Column], most: int
) -> DataFrame:
    """``file, header_row, names``, from the first ``most`` lines of each file."""
    region = (
        lines.where("block = 0").join(starts, "file").where(F.col("row") < F.col("start") + most)
        .groupBy("file").agg(F.sort_array(F.collect_list(F.struct("row", "value"))).alias("lines"))
    )
    records = region.select("file", F.explode(_records(F.col("lines"))).alias("record"))
    names = F.transform(_cells(F.col("record.text")), name)
    return (
        records.select("file", F.col("record.end").alias("header_row"), names.alias("names"))
        .where(F.size(F.array_intersect("names", known)) >= HEADER_MATCHES)
        .groupBy("file").agg(F.min(F.struct("header_row", "names")).alias("header"))
        .select("file", "header.*")
    )


def _read_split(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    name: Callable[[Column], Column],
    required: Sequence[str],
) -> DataFrame:
    lines = stored_lines(spark, path)
    starts = materialise(
        lines.where("block = 0").groupBy("file").agg(F.min("row").alias("start")), "file-starts"
    )
    known = F.array(*map(F.lit, columns))
    headers = materialise(_headers(lines, starts, known, name, _TITLE_LINES[0]), "headers")
    lost = starts.join(headers, "file", "left_anti")
    if not lost.isEmpty():
        more = _headers(lines, lost, known, name, _TITLE_LINES[1])
        headers = materialise(headers.unionByName(more), "headers")
        _reject(starts.join(headers, "file", "left_anti"), "no header row")
    for column in required:
        _reject(headers.where(~F.array_contains("names", column)), f"no column {column}")
    width = headers.agg(F.max(F.size("names"))).first()[0] or 1
    places = F.struct(*[
        F.array_position("names", F.lit(c)).cast("int").alias(f"at{i}")
        for i, c in enumerate(columns)
    ])
    placed = materialise(headers.withColumn("places", places), "header-places")
    # cells beyond the header have no name
    schema = ", ".join(f"c{i} string" for i in range(width))
    # parsed below the join: a filter on a column moves to the join, and would parse a line there
    # once for every cell
    parsed = lines.where(F.col("value").rlike(r"[^\x00-\x20]")).select(  # as the CSV reader does
        "file", "sourcefile", "block", "row", F.from_csv("value", schema).alias("parsed")
    )
    return (
        parsed.join(placed, "file")
        .where((F.col("block") > 0) | (F.col("row") > F.col("header_row")))
        .withColumn("cells", F.array(*[F.col(f"parsed.c{i}") for i in range(width)]))
        .select(
            "file", "sourcefile", "block", "row", "names",
            # place 0, of a column the file lacks, gives null
            *[
                F.get("cells", F.col(f"places.at{i}") - 1).alias(c)
                for i, c in enumerate(columns)
            ],
        )
    )


def read_titled(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    name: Callable[[Column], Column],
    *,
    required: Sequence[str] = (),
    multi_line: bool = True,
) -> DataFrame:
    """Rows below the header of each file, as text columns.

    The header is the first row in which ``name`` of the cells gives at least three of
    ``columns``. Files may differ in titles and column order; unknown columns are left out,
    absent ones are null. A file without header, or without one of the ``required`` columns, is
    an error. Returns ``file, sourcefile, block, row, names`` and the columns.

    With ``multi_line`` False files are split: cells of titles and header may hold line breaks
    (the title region of each file is read on its own), cells of the rows below may not. The
    header must be among the first 65,536 lines and in the first split of its file.
    """
    if not multi_line:
        return _read_split(spark, path, columns, name, required)
    rows = stored_cells(spark, path, multi_line)
    names = F.transform("cells", lambda cell: name(F.coalesce(cell, F.lit(""))))
    known = F.array(*map(F.lit, columns))
    headers = (
        rows.select("file", "block", "row", names.alias("names"))
        .where(F.size(F.array_intersect("names", known)) >= HEADER_MATCHES)
        .groupBy("file")
        .agg(F.min(F.struct("block", "row", "names")).alias("header"))
    )
    headers = materialise(headers, "headers")
    lost = rows.select("file").distinct().join(headers, "file", "left_anti")
    _reject(lost, "no header row")
    for column in required:
        _reject(
            headers.where(~F.array_contains("header.names", column)), f"no column {column}"
        )
    place, start = F.struct("block", "row"), F.struct("header.block", "header.row")
    return rows.join(headers, "file").where(place > start).select(
        "file", "sourcefile", "block", "row", F.col("header.names").alias("names"),
        *[
            F.get("cells", F.array_position("header.names", F.lit(c)).cast("int") - 1).alias(c)
            for c in columns
        ],
    )


def _reject(files: DataFrame, what: str) -> None:
    found = [row["file"] for row in files.select("file").limit(5).collect()]
    if found:
        raise ValueError(f"{what} in {', '.join(found)}")


def with_order(rows: DataFrame, name: str) -> DataFrame:
    """Add the number of a row over all files, in order of file path and place.

    Counted per block first; the blocks, one row each, are then put in order.
    """
    spot = Window.partitionBy("file", "block").orderBy("row")
    blocks = rows.groupBy("file", "block").agg(F.count("*").alias("rows"))
    before = Window.partitionBy().orderBy("file", "block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = blocks.select(
        "file", "block", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base")
    )
    numbered = rows.withColumn("nth", F.row_number().over(spot)).join(
        materialise(offsets, "blocks"), ["file", "block"]
    )
    return numbered.withColumn(name, (F.col("base") + F.col("nth") - 1).cast("bigint")).drop(
        "base", "nth"
    )
