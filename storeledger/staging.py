"""Intermediate tables in the folder all executors share.

A written table cuts lineage, outlives lost executors and has a known size, so
Spark broadcasts it in a later join only when it is below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; without that setting the warehouse folder that
    the session was given.

    Spark's own default for the warehouse is a folder below the driver's working directory,
    which other machines do not see; only a local session may use it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        context = spark.sparkContext
        given = context.getConf().contains("spark.sql.warehouse.dir")
        if not given and not context.master.startswith("local"):
            raise ValueError(
                "set spark.checkpoint.dir, or spark.sql.warehouse.dir, to a folder that all"
                " executors share"
            )
        folder = spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def application_folder(spark: SparkSession) -> str:
    """All staged tables of this application; may be removed once it has ended."""
    application = spark.conf.get("spark.app.id", "session")
    return f"{shared_folder(spark)}/storeledger/{application}"


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{application_folder(spark)}/{label}-{uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each write in this block when that write ends.

    Spark otherwise keeps them until the driver collects the plans as garbage, which may be after
    the last query. What is written is read from its own files, so no later query needs them.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the table read back."""
    path = staging_path(df.sparkSession, label)
    with shuffles_end(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_staged(spark: SparkSession) -> None:
    """Delete every table this application has staged; frames that read them end with it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(application_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def lookup(many: DataFrame, one: DataFrame, keys: str | list[str], how: str = "left") -> DataFrame:
    """Join rows to a table with one row per key.

    The table is written first. Spark then broadcasts it or not by its real
    size, and if not, both inputs of the join are plain shuffles, which is what
    adaptive execution needs to split a key that holds much of ``many``. (A join
    directly on the output of an aggregation is not split.)
    """
    return many.join(materialise(one, "lookup"), keys, how)
