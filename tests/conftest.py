from __future__ import annotations

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("storeledger-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", shared.as_uri())
        .config("spark.sql.warehouse.dir", (shared / "warehouse").as_uri())
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Frame from rows of text: ``frame("a, b", [("1", None)])``."""

    def make(columns: str, rows):
        schema = ", ".join(c if " " in c.strip() else f"{c} string" for c in columns.split(", "))
        return spark.createDataFrame(rows, schema)

    return make


def rows(df, *columns):
    """Rows of ``df`` as sorted tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
