"""Dimensions and facts on literal rows: the cases where a plausible reading goes wrong."""

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from tradewind.functions.labels import KEY_NULL
from tradewind.plans import marts
from tradewind.plans.warehouse import Warehouse

DAY = dt.datetime(2013, 3, 4)


def key(*parts):
    return hashlib.md5("-".join(KEY_NULL if p is None else str(p) for p in parts)
                       .encode()).hexdigest()


def header(salesorderid, **values):
    return {"salesorderid": salesorderid, "orderdate": DAY, "shipdate": DAY, "status": 5,
            "onlineorderflag": True, "customerid": 1, "billtoaddressid": 10, "territoryid": 1,
            "creditcardid": 100, "subtotal": Decimal(90), "taxamt": Decimal(8),
            "freight": Decimal(2), "totaldue": Decimal(100)} | values


def line(salesorderid, productid=7, detail=1, **values):
    return {"salesorderid": salesorderid, "salesorderdetailid": detail, "productid": productid,
            "orderqty": 3, "unitprice": Decimal(10), "unitpricediscount": Decimal("0.5")} | values


BASE = {
    "customer": [{"customerid": 1, "personid": 21, "storeid": None}],
    "person": [{"businessentityid": 21, "persontype": "IN", "firstname": "Ana",
                "lastname": "Lima"}],
    "address": [{"addressid": 10, "city": "Lyon", "stateprovinceid": 5, "postalcode": "69"}],
    "stateprovince": [{"stateprovinceid": 5, "stateprovincecode": "RA",
                       "countryregioncode": "FR", "name": "Rhône"}],
    "countryregion": [{"countryregioncode": "FR", "name": "France"}],
    "salesterritory": [{"territoryid": 1, "name": "France", "countryregioncode": "FR"},
                       {"territoryid": 2, "name": "Germany", "countryregioncode": "DE"}],
    "product": [{"productid": 7, "name": "Bolt", "productsubcategoryid": 3,
                 "standardcost": Decimal(4), "listprice": Decimal(12)}],
    "productsubcategory": [{"productsubcategoryid": 3, "productcategoryid": 2,
                            "name": "Pumps"}],
    "productcategory": [{"productcategoryid": 2, "name": "Accessories"}],
    "creditcard": [{"creditcardid": 100, "cardtype": "Vista"}],
    "salesreason": [
        {"salesreasonid": n, "name": name, "reasontype": kind} for n, name, kind in [
            (1, "Price", "Other"), (2, "On Promotion", "Promotion"),
            (3, "Manufacturer", "Other"), (5, "Quality", "Other"),
            (6, "Television Advertisement", "Marketing"), (9, None, None)]],
}


@pytest.fixture
def warehouse(spark, source):
    return lambda **tables: Warehouse(spark, source(**(BASE | tables)))


def test_fact_row(warehouse):
    rows = warehouse(salesorderheader=[header(1)], salesorderdetail=[line(1)]).mart(
        "fact_sales").collect()
    assert len(rows) == 1
    row = rows[0]
    assert row.__fields__ == list(marts.FACT_COLUMNS) and len(row) == 35
    assert row.customerfk == key(1) and row.locationfk == key(10)
    assert row.creditcardfk == key(100) and row.productfk == key(7)
    assert row.reasonfk is None and row.price is None
    assert row.factsalessk == key(1, key(1), key(10), key(100), None, DAY.date(), key(7))
    # The discount is an amount per unit.
    assert row.amountpaidproduct == Decimal("28.5")
    assert (row.city, row.stateprovince_name, row.territory_name, row.countryregion_name) == (
        "Lyon", "Rhône", "França", "França")
    assert (row.standardcost, row.listprice, row.statussales) == (4, 12, "Enviado")


def test_line_without_header_is_kept(warehouse):
    row = warehouse(salesorderheader=[header(1)], salesorderdetail=[line(2)]).mart(
        "fact_sales").first()
    assert row.salesorderid is None and row.totaldue is None and row.statussales is None
    assert row.productfk == key(7) and row.orderqty == 3
    assert row.factsalessk == key(None, None, None, None, None, None, key(7))


def test_same_product_twice_shares_the_fact_key(warehouse):
    tables = warehouse(salesorderheader=[header(1)],
                       salesorderdetail=[line(1, detail=1), line(1, detail=2)])
    rows = marts.fact_sales(tables, line_key=True).collect()
    assert len({row.factsalessk for row in rows}) == 1
    assert len({row.fact_line_sk for row in rows}) == 2
    failures = {(r.column_name, r.test): r.failures for r in tables.check_marts().where(
        "model = 'fact_sales'").collect()}
    assert failures["factsalessk", "unique"] == 1


def test_unknown_status_has_no_label(warehouse):
    assert warehouse(salesorderheader=[header(1, status=7)], salesorderdetail=[line(1)]).mart(
        "fact_sales").first().statussales is None


def test_repeated_header_row_counts_once(warehouse):
    tables = warehouse(salesorderheader=[header(1), header(1)], salesorderdetail=[line(1)])
    assert tables.mart("fact_sales").count() == 1


@pytest.mark.parametrize("table", ["address", "stateprovince", "countryregion",
                                   "salesterritory"])
def test_repeated_location_rows_count_once(warehouse, table):
    tables = warehouse(salesorderheader=[header(1)], salesorderdetail=[line(1)],
                       **{table: BASE[table] * 3})
    assert tables.mart("fact_sales").count() == tables.mart("dim_locations").count() == 1


def test_checked_keys_give_the_same_marts(small):
    checked = Warehouse(small.spark, small.source, keys_checked=True)
    for name in marts.MARTS:
        assert rows_of(checked.mart(name)) == rows_of(small.mart(name)), name


def test_missing_references(warehouse):
    row = warehouse(
        salesorderheader=[header(1, customerid=2, creditcardid=None, billtoaddressid=11)],
        salesorderdetail=[line(1, productid=None)]).mart("fact_sales").first()
    assert row.customerfk is None      # not in the customer table
    assert row.creditcardfk is None and row.productfk is None
    assert row.locationfk == key(11) and row.city is None


def test_dim_customers(warehouse):
    tables = warehouse(
        salesorderheader=[header(1), header(2), header(3, customerid=2),
                          header(4, customerid=3)],
        customer=[{"customerid": 1, "personid": 21, "storeid": 31},
                  {"customerid": 2, "personid": 22}, {"customerid": 4}],
        person=[*BASE["person"], {"businessentityid": 22, "persontype": "??",
                                  "firstname": "Rui", "lastname": None}],
        store=[{"businessentityid": 31, "name": "Shop"}])
    rows = {row.customersk: row for row in tables.mart("dim_customers").collect()}
    assert set(rows) == {key(1), key(2), key(3)}
    ana = rows[key(1)]
    assert (ana.customerfullname, ana.customerpersontype, ana.namestore) == (
        "Ana Lima", "Cliente individual", "Shop")
    rui = rows[key(2)]
    assert rui.customerfullname is None and rui.customerpersontype == "Desconhecido"
    assert rows[key(3)].customerid is None


def test_dim_products(warehouse):
    rows = warehouse(salesorderdetail=[line(1), line(2), line(3, 8), line(4, None)],
                     product=[*BASE["product"], {"productid": 9}]).mart("dim_products").collect()
    found = {row.productid: (row.product_name, row.productsubcategory_name,
                             row.productcategory_name) for row in rows}
    assert found == {7: ("Bolt", "Bombas", "Acessórios"), 8: (None, None, None)}


def test_address_with_two_territories(warehouse):
    tables = warehouse(salesorderheader=[header(1), header(2, territoryid=2)],
                       salesorderdetail=[line(1), line(2)])
    locations = tables.mart("dim_locations").collect()
    assert {row.locationsk for row in locations} == {key(10)}
    assert {row.territory_name for row in locations} == {"França", "Alemanha"}
    failures = {r.column_name: r.failures for r in tables.check_marts().where(
        "model = 'dim_locations' and test = 'unique'").collect()}
    assert failures == {"locationsk": 1, "addressid": 1}
    # Each line keeps the territory of its own order and is not repeated.
    fact = {row.salesorderid: row.territory_name for row in tables.mart("fact_sales").collect()}
    assert fact == {1: "França", 2: "Alemanha"} and tables.mart("fact_sales").count() == 2


def test_dim_creditcards(warehouse):
    rows = warehouse(salesorderheader=[header(1), header(2), header(3, creditcardid=None),
                                       header(4, creditcardid=101)]).mart(
        "dim_creditcards").collect()
    assert {(r.creditcardid, r.cardtype) for r in rows} == {(100, "Vista"), (101, None)}


@pytest.mark.parametrize(("reasons", "label", "flags"), [
    ([1], "Preço", {"price"}),
    ([1, 1], "Preço", {"price"}),
    # Names are joined alphabetically, so "Price | On Promotion" never arises.
    ([1, 2], "On Promotion | Price", {"price", "promotion"}),
    ([5, 3], "Fabricante | Qualidade", {"quality", "manufacturer"}),
    ([6], "Anúncio de televisão", {"television"}),
    ([2], "Em promoção", {"promotion"}),
    # A reason without a name, and one that is not in the lookup.
    ([9], "", set()),
    ([77], "", set()),
    ([77, 1], "Preço", {"price"}),
])
def test_dim_reasons(warehouse, reasons, label, flags):
    row = warehouse(salesorderheadersalesreason=[
        {"salesorderid": 1, "salesreasonid": reason} for reason in reasons]).mart(
        "dim_reasons").first()
    assert row.salesreason_name == label and row.reasonsk == key(1)
    assert {flag for flag in marts.REASON_COLUMNS[2:] if row[flag] == 1} == flags
    assert {row[flag] for flag in marts.REASON_COLUMNS[2:]} <= {0, 1}


def test_reason_types_are_sorted_on_their_own(warehouse):
    row = warehouse(salesorderheadersalesreason=[
        {"salesorderid": 1, "salesreasonid": reason} for reason in (1, 2, 6)]).mart(
        "dim_reasons").first()
    assert row.salesreason_name == "On Promotion | Price | Television Advertisement"
    assert row.reasontype == "Marketing | Other | Promotion"


def test_dim_dates(warehouse):
    tables = warehouse()
    rows = marts.dim_dates(tables, "2011-01-01", "2015-01-01").orderBy("metric_date").collect()
    assert len(rows) == 1461
    assert (rows[0].metric_date, rows[-1].metric_date) == (
        dt.date(2011, 1, 1), dt.date(2014, 12, 31))
    leap = next(row for row in rows if row.metric_date == dt.date(2012, 2, 29))
    assert tuple(leap) == (dt.date(2012, 2, 29), 29, 2, 2012, 1, 1, "Quarta-feira", "Fevereiro")
    assert rows[0].dayofweek == "Sábado"
    assert {row.semester for row in rows if row.metric_month > 6} == {2}


def test_calendar_covers_the_years_of_the_orders(warehouse):
    days = warehouse(salesorderheader=[
        header(1, orderdate=dt.datetime(2012, 12, 31, 23)), header(2)]).mart("dim_dates")
    assert days.count() == 366 + 365


def test_sales_force_aggregate(warehouse):
    sellers = [{"businessentityid": n} for n in (51, 52, 53)]
    people = [{"businessentityid": n, "jobtitle": "Sales Representative", "gender": "F"}
              for n in (51, 52)] + [{"businessentityid": 54, "jobtitle": "Buyer", "gender": "M"}]
    orders = [header(1, salespersonid=51), header(1, salespersonid=51),
              header(2, salespersonid=52), header(3, salespersonid=51, territoryid=2),
              header(4, salespersonid=53), header(5, salespersonid=54), header(6)]
    rows = warehouse(salesperson=sellers, employee=people, salesorderheader=orders).mart(
        "fact_aggsalessellersregion").collect()
    found = {(r.countryregion_name, r.jobtitle, r.gender): r.totalsalesorders for r in rows}
    title = "Representante de vendas"
    # Employee 54 is not a salesperson, so nothing is known about the seller of order 5.
    assert found == {("França", title, "F"): 2, (None, title, "F"): 1, ("França", None, None): 2}
    assert {r.agg_salesregionpersonsk for r in rows} == {key(*group) for group in found}


def test_equal_lines_of_a_hot_order_spread(spark, warehouse):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = warehouse(salesorderheader=[header(1)], salesorderdetail=[line(1)] * 400)
        fact = marts.fact_sales(tables, rows_per_split=20)
        tasks = fact.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(row["count"] for row in tasks) == 400
    assert max(row["count"] for row in tasks) < 200


def test_hot_order_gives_the_same_fact(warehouse):
    tables = warehouse(
        salesorderheader=[header(n) for n in range(1, 6)],
        salesorderdetail=[line(1, detail=n) for n in range(40)] + [line(n) for n in range(2, 8)])
    plain = sorted(map(str, marts.fact_sales(tables).collect()))
    cut = sorted(map(str, marts.fact_sales(tables, rows_per_split=3).collect()))
    assert plain == cut and len(cut) == 46


def test_fact_from_the_rollup_is_the_same(spark, warehouse):
    # Order 1 and the missing order 90 are hot, some lines have no order id.
    plain = warehouse(
        salesorderheader=[header(n) for n in range(1, 6)],
        salesorderdetail=[line(1, detail=n) for n in range(40)] + [line(90)] * 30
        + [line(None)] * 20 + [line(n) for n in range(2, 8)])
    rollup = plain.mart("order_totals")
    assert rollup.where("salesorderid is null").count() == 4
    tables = Warehouse(spark, plain.source, {"order_totals": rollup})
    expected = rows_of(marts.fact_sales(plain))
    assert len(expected) == 96
    assert rows_of(marts.fact_sales(tables, rows_per_split=7)) == expected
    assert rows_of(marts.fact_sales(plain, rows_per_split=7)) == expected


@pytest.mark.parametrize("checked", [False, True])
def test_gathered_orders_equal_orders_looked_up_one_by_one(warehouse, checked):
    headers = [header(n, customerid=n % 3 or None, billtoaddressid=n % 4 or None,
                      territoryid=n % 2 or None) for n in range(8)]
    tables = {"salesorderheader": headers}
    if not checked:  # repeated rows, ids with several headers or none, repeated addresses
        tables = {"salesorderheader": headers * 2 + [
            header(1, customerid=9), header(1, billtoaddressid=2, totaldue=Decimal("8.5")),
            header(None, customerid=1)],
                  "address": [{"addressid": 2, "stateprovinceid": n} for n in (5, 6, 7, 7)]}
    found = warehouse(**tables)
    found.keys_checked = checked
    columns = ("customerfk", "locationfk", "creditcardfk", *marts.HEADER_COLUMNS,
               *marts.LOCATION_COLUMNS)
    names = ["salesorderid", *marts.NATURAL_KEYS, "customer_known", *columns[3:]]
    expected = marts.order_rows(found, columns).where("salesorderid IS NOT NULL")
    assert rows_of(marts.gathered_order_rows(found, columns).select(names)) == rows_of(
        expected.select(names))
