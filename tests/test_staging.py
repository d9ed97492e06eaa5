"""Labels, NULL handling and renames of the staging frames, on literal rows."""

import datetime as dt

import pytest

from tradewind.functions import labels
from tradewind.plans.staging import STAGING
from tradewind.plans.warehouse import Warehouse

NOON = dt.datetime(2013, 5, 6, 12, 30)


@pytest.fixture
def staged(spark, source):
    def stage(name, rows):
        table = STAGING[name][1]
        return Warehouse(spark, source(**{table: rows})).stg(name).collect()
    return stage


@pytest.mark.parametrize(("name", "column", "label", "table", "fallback"), [
    ("stg_countryregion", "name", "countryregion_name", labels.COUNTRY_LABELS, None),
    ("stg_employee", "jobtitle", "jobtitle", labels.JOB_TITLE_LABELS, None),
    ("stg_person", "persontype", "persontype", labels.PERSON_TYPE_LABELS, "Desconhecido"),
    ("stg_productcategory", "name", "productcategory_name", labels.CATEGORY_LABELS, None),
    ("stg_productsubcategory", "name", "productsubcategory_name", labels.SUBCATEGORY_LABELS,
     "Outro"),
    ("stg_salesorderheader", "status", "statussales", labels.STATUS_LABELS, None),
    ("stg_salesterritory", "name", "territory_name", labels.TERRITORY_LABELS, None),
])
def test_labels(staged, name, column, label, table, fallback):
    other = 99 if column == "status" else "something else"
    keys = [*table, other, None]
    found = [row[label] for row in staged(name, [{column: key} for key in keys])]
    assert found == [*table.values(), fallback, fallback]


def test_label_table_sizes():
    sizes = [len(table) for table in (
        labels.COUNTRY_LABELS, labels.TERRITORY_LABELS, labels.JOB_TITLE_LABELS,
        labels.PERSON_TYPE_LABELS, labels.CATEGORY_LABELS, labels.SUBCATEGORY_LABELS,
        labels.STATUS_LABELS, labels.REASON_LABELS, labels.REASON_FLAGS)]
    assert sizes == [6, 10, 4, 6, 4, 36, 6, 12, 7]
    assert labels.SUBCATEGORY_LABELS["Bib-Shorts"] == labels.SUBCATEGORY_LABELS["Shorts"]


def test_timestamps_become_dates(staged):
    header = staged("stg_salesorderheader", [{
        "orderdate": NOON, "duedate": NOON, "shipdate": NOON, "modifieddate": NOON}])[0]
    assert {header[c] for c in ("orderdate", "duedate", "shipdate", "modifieddate")} == {
        NOON.date()}
    product = staged("stg_product", [{
        "sellstartdate": NOON, "sellenddate": NOON, "discontinueddate": NOON}])[0]
    assert product.sellstartdate == product.sellenddate == NOON.date()
    assert product.discontinueddate == NOON


def test_employee_keeps_timestamp_and_adds_date(staged):
    employee = staged("stg_employee", [{"modifieddate": NOON}])[0]
    assert (employee.modifieddate, employee.modified_date) == (NOON, NOON.date())


def test_renames(staged):
    assert staged("stg_product", [{"name": "Bolt"}])[0].product_name == "Bolt"
    assert staged("stg_salesreason", [{"name": "Price"}])[0].salesreason_name == "Price"
    assert staged("stg_stateprovince", [{"name": "Ohio"}])[0].stateprovince_name == "Ohio"
    assert staged("stg_store", [{"name": "Shop"}])[0].namestore == "Shop"
    assert staged("stg_salesterritory", [{"group": "Europe"}])[0].territorygroup == "Europe"


def test_every_staging_frame_keeps_all_rows(small):
    for name, (schema, table, _) in STAGING.items():
        assert small.stg(name).count() == small.source.table(schema, table).count(), name
