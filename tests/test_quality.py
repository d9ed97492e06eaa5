"""Data checks on literal rows, and their known results on the feed."""

import pytest

from tradewind.functions.columns import packed, unpacked
from tradewind.operators import quality
from tradewind.operators.quality import (
    Checks,
    Reference,
    not_null,
    relationships,
    run_checks,
    unique,
)
from tradewind.plans.checks import MART_CHECKS, SOURCE_CHECKS


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(1, "a", 1), (1, "b", 2), (2, "a", None), (3, "a", 9), (None, None, 9), (None, "c", 9)],
        "number int, letter string, parent bigint")


def found(report):
    return {row.column_name: row.failures for row in report.collect()}


def test_unique_counts_repeated_values_and_ignores_null(rows):
    assert found(unique(rows, ["number"])) == {"number": 1}
    assert found(unique(rows, ["number", "letter", "parent"])) == {
        "number": 1, "letter": 1, "parent": 1}


def test_not_null(rows):
    assert found(not_null(rows, ["number", "letter", "parent"])) == {
        "number": 2, "letter": 1, "parent": 1}


def test_relationships_count_rows(spark, rows):
    parents = {"numbers": spark.createDataFrame([(1,), (2,), (3,)], "id bigint"),
               "letters": spark.createDataFrame([("a",), ("c",)], "name string")}
    references = [Reference("parent", "numbers", "id"), Reference("letter", "letters", "name"),
                  Reference("number", "numbers", "id")]
    assert found(relationships(rows, references, parents.get)) == {
        "parent": 3, "letter": 1, "number": 0}
    assert found(relationships(rows, references[:1], parents.get)) == {"parent": 3}


def test_report_over_empty_and_failing_models(spark, rows):
    models = {"full": rows, "empty": rows.limit(0)}
    checks = Checks(unique=["number"], not_null=["letter"],
                    references=[Reference("number", "full", "number")])
    report = run_checks(models.get, {"full": checks, "empty": checks}).collect()
    assert {(r.model, r.test): (r.failures, r.passed) for r in report} == {
        ("full", "unique"): (1, False), ("full", "not_null"): (1, False),
        ("full", "relationships"): (0, True), ("empty", "unique"): (0, True),
        ("empty", "not_null"): (0, True), ("empty", "relationships"): (0, True)}


def test_declared_checks():
    def count(spec, kind):
        return sum(len(getattr(checks, kind)) for checks in spec.values())
    kinds = ("unique", "not_null", "references")
    assert [count(SOURCE_CHECKS, kind) for kind in kinds] == [15, 17, 0]
    assert [count(MART_CHECKS, kind) for kind in kinds] == [11, 64, 6]
    fact = MART_CHECKS["fact_sales"]
    assert len(fact.unique) + len(fact.not_null) + len(fact.references) == 24


def test_known_failures(built):
    failing = built.check_marts().where("not passed").collect()
    assert {(r.model, r.column_name, r.test): r.failures for r in failing} == {
        ("dim_customers", "customerfirstname", "not_null"): 3,
        ("dim_customers", "customerlastname", "not_null"): 3,
        ("dim_customers", "customerfullname", "not_null"): 3,
        ("dim_customers", "customerpersontype", "not_null"): 3,
        ("dim_locations", "territory_name", "not_null"): 30,
        ("dim_locations", "countryregion_name", "not_null"): 34,
        ("dim_products", "productsubcategory_name", "not_null"): 20,
        ("dim_products", "productcategory_name", "not_null"): 20,
        ("fact_aggsalessellersregion", "countryregion_name", "not_null"): 10,
        ("fact_aggsalessellersregion", "jobtitle", "not_null"): 10,
        ("fact_sales", "factsalessk", "unique"): 57,
        ("fact_sales", "statussales", "not_null"): 880,
    }


def test_sources_pass(small):
    report = small.check_sources()
    assert report.count() == 32 and report.where("not passed").count() == 0


@pytest.mark.parametrize("slots", [1, 1 << 20])
def test_unique_of_written_rows_counts_the_same(rows, monkeypatch, slots):
    monkeypatch.setattr(quality, "SLOTS", slots)  # in one slot all values are counted
    columns = ["number", "letter", "parent"]
    assert found(unique(rows, columns, written=True)) == found(unique(rows, columns))
    assert found(unique(rows.limit(0), columns, written=True)) == dict.fromkeys(columns, 0)


def test_unique_of_written_rows_shuffles_hashes_and_few_values(rows):
    plan = unique(rows, ["letter"], written=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(hash#" in plan
    assert "LeftSemi, BuildRight" in plan


def test_relationships_tell_hashes_and_texts_apart(spark):
    hashed = "0123456789abcdef" * 2
    values = [hashed, hashed.upper(), hashed + "\n", hashed[:30], hashed[:15], "", "ação", None]
    rows = spark.createDataFrame([(value,) for value in values], "name string")
    for value in values[:-1]:
        parents = spark.createDataFrame([(value,), (None,)], "name string")
        assert found(relationships(rows, [Reference("name", "all", "name")],
                                   {"all": parents}.get)) == {"name": 6}


def test_packed_keys_come_back(spark):
    hashed = "0123456789abcdef" * 2
    values = [hashed, hashed.upper(), hashed + "\n", "a", "", "ação", None]
    rows = spark.createDataFrame([(value,) for value in values], "name string")
    kept = rows.select("name", packed("name").alias("bytes"))
    assert kept.where("length(bytes) = 16").count() == 1
    assert all(row.name == row.text for row in kept.select(
        "name", unpacked("bytes").alias("text")).collect())
