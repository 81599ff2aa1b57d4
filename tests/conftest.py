from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("gaugemill-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "checkpoints"))
        .config("spark.sql.maxMetadataStringLength", "1000")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def database(spark, tmp_path, request):
    """An empty database of the test's own."""
    name = f"db_{abs(hash(request.node.nodeid))}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path / 'tables'}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def setting(spark):
    """Change session settings for one test."""
    changed = {}

    def change(key: str, value: str) -> None:
        changed.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def rows(frame):
    """All rows as a sorted list of tuples."""
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
