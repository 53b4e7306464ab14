"""One reference row per location."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.config import SOURCES
from storeledger.operators.cells import PLACE, located
from storeledger.operators.unify import source_rank

LOCATION_COLUMNS = ("location_code", "chain", *PLACE)


def location_ref(cells: DataFrame) -> DataFrame:
    """Most frequent place values of each location and the chain it belongs to.

    A field's value is the one on most sales, the smallest among equals, and
    ``""`` when there is none. Counting (location, field, value) first keeps a
    location with very many sales spread over tasks.
    """
    counted = (
        located(cells)
        .groupBy("location_code", *PLACE)
        .agg(F.sum("lines").alias("lines"), F.min(source_rank()).alias("rank"))
    )
    fields = F.array(
        *[F.struct(F.lit(name).alias("field"), F.col(name).alias("value")) for name in PLACE]
    )
    values = (
        counted.select("location_code", "lines", "rank", F.inline(fields))
        .groupBy("location_code", "field", "value")
        .agg(F.sum("lines").alias("lines"), F.min("rank").alias("rank"))
    )
    most_first = F.struct((-F.col("lines")).alias("order"), F.col("value"))

    def winner(name: str):
        candidate = (F.col("field") == name) & F.col("value").isNotNull()
        return F.coalesce(F.min(F.when(candidate, most_first))["value"], F.lit("")).alias(name)

    return (
        values.groupBy("location_code")
        .agg(F.min("rank").alias("rank"), *[winner(name) for name in PLACE])
        .withColumn("chain", F.element_at(F.array(*map(F.lit, SOURCES)), F.col("rank")))
        .select(*LOCATION_COLUMNS)
    )


def one_per_location(location_map: DataFrame) -> DataFrame:
    """Smallest row per code, for a map edited by hand that may repeat one."""
    rest = [name for name in location_map.columns if name != "location_code"]
    return (
        located(location_map)
        .groupBy("location_code")
        .agg(F.min(F.struct(*rest)).alias("row"))
        .select("location_code", "row.*")
    )


def enrich(report: DataFrame, location_map: DataFrame) -> DataFrame:
    """Add name, chain and CRM customer to a report keyed by location.

    The map is a stored table with one row per location.
    """
    details = location_map.select(
        "location_code", "customer_name", "chain", "crm_customer_id", "crm_customer_name"
    )
    return report.join(details, "location_code", "left")
