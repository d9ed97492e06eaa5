from __future__ import annotations

import os
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tradewind.plans.warehouse import Warehouse, build_warehouse  # noqa: E402
from tradewind.sources.feed import OrdersFeed  # noqa: E402
from tradewind.sources.tables import TABLES, FrameSource  # noqa: E402

DATA = os.environ.get("TEST_DATA", "/root/testdata")
SMALL = f"{DATA}/sf0.001"
MEDIUM = f"{DATA}/sf0.01"
FEED_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "4g")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.maxMetadataStringLength", "500")  # whole paths in plans
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("catalog")))
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    """Lazy warehouse over the smallest feed."""
    return Warehouse(spark, OrdersFeed(spark, SMALL))


@pytest.fixture(scope="session")
def built(spark, tmp_path_factory):
    """The same warehouse, written to tables; without its source."""
    location = str(tmp_path_factory.mktemp("warehouse"))
    build_warehouse(spark, OrdersFeed(spark, SMALL), location)
    return Warehouse.open(spark, location)


@pytest.fixture(scope="session")
def sql():
    """The other engine, with the smallest feed's tables as views."""
    connection = duckdb.connect()
    for table in FEED_TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


@pytest.fixture(scope="session")
def source(spark):
    """Build a source from literal rows: ``source(salesorderheader=[{...}, ...])``."""
    schemas = {name: columns for (_, name), columns in TABLES.items()}

    def build(**tables):
        frames = {}
        for name, rows in tables.items():
            empty = spark.createDataFrame([], schemas[name])
            fields = empty.schema
            unknown = {key for row in rows for key in row} - set(fields.names)
            assert not unknown, unknown
            frames[name] = spark.createDataFrame(
                [tuple(row.get(column) for column in fields.names) for row in rows], fields)
        return FrameSource(spark, frames)
    return build


def rows_of(frame) -> list[tuple]:
    """Rows as tuples in column-name order, sorted."""
    columns = sorted(frame.columns)
    found = [tuple(row[column] for column in columns) for row in frame.collect()]
    return sorted(found, key=lambda row: [(value is None, str(value)) for value in row])
