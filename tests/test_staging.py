"""Where intermediate tables go."""

from __future__ import annotations

import pytest

from storeledger import staging


class Settings(dict):
    def contains(self, key):
        return key in self


class Session:
    """A session's settings, as far as the choice of a folder needs them."""

    def __init__(self, master, given, settings):
        self.conf = Settings(settings)
        self.sparkContext = type("Context", (), {
            "master": master, "getConf": lambda _: Settings(given)})()


DEFAULT = {"spark.sql.warehouse.dir": "file:/here/spark-warehouse"}
WAREHOUSE = {"spark.sql.warehouse.dir": "hdfs://store/warehouse"}


def test_checkpoint_folder_first():
    settings = {"spark.checkpoint.dir": "hdfs://store/shared/", **DEFAULT}
    assert staging.shared_folder(Session("yarn", {}, settings)) == "hdfs://store/shared"


def test_warehouse_that_was_set_or_a_local_session():
    session = Session("spark://main:7077", WAREHOUSE, WAREHOUSE)
    assert staging.shared_folder(session) == "hdfs://store/warehouse"
    session = Session("local[4]", {}, DEFAULT)
    assert staging.shared_folder(session) == "file:/here/spark-warehouse"


def test_no_folder_of_the_driver_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session("yarn", {}, DEFAULT))


def test_session_settings(spark):
    assert staging.staging_path(spark, "x").startswith(
        spark.conf.get("spark.checkpoint.dir").rstrip("/") + "/storeledger/")
