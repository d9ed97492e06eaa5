"""Every registered query with comparison SQL returns the same rows and types."""

import pytest

import __spark_entry__ as registry
from conftest import SMALL, rows_of

QUERIES = registry.core_queries()
ORACLE = {name: text for name, text in registry.oracle_sql().items() if name in QUERIES}
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE",
         "boolean": "BOOLEAN", "double": "DOUBLE", "timestamp": "TIMESTAMP",
         "timestamp_ntz": "TIMESTAMP"}


def test_every_comparison_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {
        "cv_scores", "model_metrics", "champion", "feature_importance", "forecast",
        "champion_forecast", "champion_forecast_by_country", "champion_forecast_by_category"}


@pytest.mark.parametrize("name", ORACLE)
def test_matches_sql(name, spark, sql):
    result = QUERIES[name](spark, SMALL)
    expected = sql.sql(ORACLE[name])
    assert sorted(result.columns) == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types), strict=True))
    for column, kind in result.dtypes:
        assert TYPES.get(kind, kind.upper()) == types[column], column
    order = [expected.columns.index(column) for column in sorted(expected.columns)]
    rows = sorted((tuple(row[i] for i in order) for row in expected.fetchall()),
                  key=lambda row: [(value is None, str(value)) for value in row])
    assert rows_of(result) == rows


def test_entry(spark):
    assert registry.entry(spark).count() == 10


def test_a_changed_table_makes_a_new_training_run(spark, tmp_path, monkeypatch):
    runs = []
    monkeypatch.setattr(registry, "_train", lambda *_: runs.append(1) or len(runs))
    monkeypatch.setattr(registry, "_RUNS", {})
    folder = f"{tmp_path}/tables"
    for table in registry.FEED_TABLES:
        spark.range(1).write.parquet(f"{folder}/{table}.parquet")
    query = registry._trained(lambda run: run)
    assert [query(spark, folder), query(spark, folder)] == [1, 1]
    spark.range(2).write.mode("append").parquet(f"{folder}/orders.parquet")
    assert [query(spark, folder), query(spark, folder)] == [2, 2]
    registry.forget_training_runs()
    assert query(spark, folder) == 3
