from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from tickloom.session import SETTINGS


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[4]").appName("tests")
    own = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
        "spark.sql.warehouse.dir": f"file://{tmp_path_factory.mktemp('warehouse')}",
    }
    for key, value in (SETTINGS | own).items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
