"""The uneven-key joins return exactly the plain left join."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from tradewind.operators.joins import (
    hot_keys,
    key_counts,
    left_join_hot,
    left_join_nullable,
)


@pytest.fixture(scope="module")
def lines(spark):
    chance = random.Random(7)
    # Key 1 holds a third of all rows, NULL another large part, key 50 has no match.
    keys = [1] * 400 + [None] * 200 + [50] * 100 + [chance.randrange(2, 40) for _ in range(500)]
    chance.shuffle(keys)
    return spark.createDataFrame(
        [(key, number, number % 7) for number, key in enumerate(keys)],
        "left_id bigint, line bigint, kind int").repartition(6)


@pytest.fixture(scope="module")
def headers(spark):
    # Key 3 occurs twice, and one row has no key.
    ids = [*range(1, 40), 3, None]
    return spark.createDataFrame([(key, f"order {n}") for n, key in enumerate(ids)],
                                 "right_id bigint, name string")


@pytest.mark.parametrize("rows_per_split", [1, 30, 100, 10_000])
def test_hot_join_equals_plain_join(lines, headers, rows_per_split):
    plain = lines.join(headers, lines.left_id == headers.right_id, "left")
    hot = left_join_hot(lines, headers, "left_id", "right_id", spread_by="line",
                        rows_per_split=rows_per_split)
    assert hot.columns == plain.columns
    assert rows_of(hot) == rows_of(plain)


def test_hot_keys(lines):
    counts = key_counts(lines, "left_id")
    # A key that is listed twice still counts once.
    hot = hot_keys(counts.union(counts), 90).collect()
    assert len(hot) == 3
    assert {row["_hot_key"]: row["_parts"] for row in hot} == {1: 5, None: 3, 50: 2}


def test_hot_key_spreads_over_tasks(spark, lines, headers):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = left_join_hot(lines, headers, "left_id", "right_id", spread_by="line",
                               rows_per_split=20)
        tasks = (joined.where("left_id = 1").groupBy(F.spark_partition_id().alias("task"))
                 .count().collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(tasks) >= 5
    assert max(row["count"] for row in tasks) < 200


def test_nullable_join_equals_plain_join_and_spreads(spark, lines, headers):
    plain = lines.join(headers, lines.left_id == headers.right_id, "left")
    joined = left_join_nullable(lines, headers, "left_id", "right_id", spread_by="line")
    assert joined.columns == plain.columns
    assert rows_of(joined) == rows_of(plain)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = left_join_nullable(lines, headers, "left_id", "right_id", spread_by="line")
        tasks = (joined.where("left_id is null").groupBy(F.spark_partition_id().alias("task"))
                 .count().collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(tasks) == 8
