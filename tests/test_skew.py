"""Tables where one key holds a third of the rows: same results, split joins."""

from __future__ import annotations

import contextlib
import io

import duckdb
import pytest

import __spark_entry__ as entry
from storeledger.operators import matching
from storeledger.workload.star import CONFIG
from tests.oracle import TABLES, connect, differences

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """A third of the orders from one customer, a third of the lines on one part,
    a third of the lines on one order, a third of the customers in one nation."""
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    changed = {
        "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END"
        " AS o_custkey) FROM {t}",
        "lineitem": "SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 3 ELSE l_partkey END"
        " AS l_partkey, CASE WHEN l_orderkey % 3 = 1 THEN 1 ELSE l_orderkey END AS l_orderkey)"
        " FROM {t}",
        "customer": "SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 5 ELSE c_nationkey END"
        " AS c_nationkey) FROM {t}",
    }
    for name in TABLES:
        query = changed.get(name, "SELECT * FROM {t}").format(t=f"'{SF}/{name}.parquet'")
        # several row groups, so that a hot key comes from several map tasks
        con.execute(f"COPY ({query}) TO '{folder}/{name}.parquet' (ROW_GROUP_SIZE 2048)")
    return str(folder)


@pytest.fixture
def splitting(spark):
    """Shuffled joins only, and skew handling from the first kilobytes on."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.files.maxPartitionBytes": "24k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", [
    "unified_sales", "precedence_dedup", "location_map", "location_snapshot", "top_skus",
    "sales_by_sku_location_month_long", "form_payloads", "match_contains", "match_contained_by",
    "reconcile_invoices", "sku_alias",
])
def test_skewed_tables_give_whole_results(splitting, skewed, name):
    query = entry.queries()[name](splitting, skewed)
    assert differences(query, connect(skewed), SQL[name]) == []


def one_street_number(spark, folder):
    """Locations of a chain of which two thirds have the same street number."""
    known = spark.range(30_000).selectExpr(
        "concat('L', id) as location_code", "'chain_a' as chain",
        "concat('LPQ ', if(id % 3 = 0, 200 + id % 700, 150), ' No ', id) as norm_name",
        "'' as norm_addr",
    )
    crm = spark.range(1000).selectExpr(
        "id as ref_ord", "concat('LPQ BAKERY ', id) as norm_name",
        "concat(id, ' MARKET AVE') as norm_addr",
    )
    known.repartition(16).write.parquet(f"{folder}/street-locations", "overwrite")
    stored = spark.read.parquet(f"{folder}/street-locations")
    return matching.match_street_number(stored, crm, CONFIG)


def test_hot_street_number_gives_whole_results(splitting, skewed):
    found = one_street_number(splitting, skewed).collect()
    assert len(found) == 30_000
    assert all(
        r.hit == (200 + int(r.location_code[1:]) % 700 if int(r.location_code[1:]) % 3 == 0 else 150)
        for r in found
    )


# frames of their own where the tables cannot hold the hot key
OWN = {"match_street_number": one_street_number}


@pytest.mark.parametrize("name", ["unified_sales", "sku_alias", "match_street_number"])
def test_hot_keys_are_split(splitting, skewed, name):
    query = OWN.get(name, entry.queries()[name])(splitting, skewed)
    query.collect()
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        query.explain()
    assert "skew=true" in out.getvalue()
