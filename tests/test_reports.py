"""Reports: the same from lazy and written warehouses, and known totals."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM, SMALL, rows_of
from test_marts import BASE, header, line
from tradewind.plans import reports
from tradewind.plans.customers import CUSTOMER_REPORTS, customer_counts, customers_by_month
from tradewind.plans.sales import is_sale, monthly_sales, order_sales, over_lines
from tradewind.plans.warehouse import Warehouse
from tradewind.sources.feed import OrdersFeed


@pytest.mark.parametrize("name", reports.REPORTS)
def test_built_warehouse_gives_the_same_report(name, small, built):
    report = reports.REPORTS[name]
    lazy, written = report(small), report(built)
    assert lazy.dtypes == written.dtypes
    assert rows_of(lazy) == rows_of(written)


class Repeated(OrdersFeed):
    """The feed with every looked-up row and every header given twice."""

    def table(self, schema, name):
        rows = super().table(schema, name)
        once = ("salesorderdetail", "salesorderheadersalesreason", "salesreason")
        return rows if name in once else rows.unionByName(rows)


@pytest.mark.parametrize("name", reports.REPORTS)
def test_repeated_rows_of_unchecked_sources_change_no_report(name, spark, small):
    report = reports.REPORTS[name]
    assert rows_of(report(Warehouse(spark, Repeated(spark, SMALL)))) == rows_of(report(small))


def test_reports_of_repeated_rows_equal_sql_over_the_fact(spark):
    warehouse = Warehouse(spark, Repeated(spark, SMALL))
    fact = warehouse.mart("fact_sales").where(is_sale())
    counted = fact.agg(F.count_distinct("salesorderid"), F.count_distinct("customerfk"),
                       F.sum("orderqty")).first()
    found = reports.kpi_general(warehouse).first()
    assert (found.total_orders, found.total_customers, found.total_items_sold) == tuple(counted)


@pytest.mark.parametrize("series", [
    None, "countryregion_name", "onlineorderflag", "productcategory_name", "product_name"])
def test_built_warehouse_gives_the_same_series(series, small, built):
    assert rows_of(monthly_sales(small, series)) == rows_of(monthly_sales(built, series))


@pytest.fixture
def warehouse(spark, source):
    def build(**tables):
        return Warehouse(spark, source(**(BASE | tables)))
    return build


@pytest.fixture
def mixed(warehouse):
    """Two sales with 2 and 1 lines, one cancelled, one of unknown state, one orphan line."""
    return warehouse(
        salesorderheader=[
            header(1), header(2, onlineorderflag=None, totaldue=Decimal(50), customerid=9,
                              orderdate=dt.datetime(2013, 5, 1)),
            header(3, status=6), header(4, status=9), header(5)],
        salesorderdetail=[line(1), line(1, detail=2), line(2), line(3), line(4), line(99)])


def test_line_and_order_grain(mixed):
    by_line = reports.kpi_general(mixed).first()
    by_order = reports.kpi_order_grain(mixed).first()
    assert by_line.total_orders == by_order.total_orders == 2
    assert by_line.total_customers == by_order.total_customers == 1   # customer 9 is unknown
    assert (by_line.total_revenue, by_order.total_revenue) == (250, 150)
    assert (by_line.avg_order_value, by_order.avg_order_value) == (Decimal("83.33"), 75)
    assert by_line.total_product_revenue == by_order.total_product_revenue == Decimal("85.5")
    assert by_line.total_items_sold == 9


def test_channel_without_flag_is_the_store(mixed):
    found = {row.channel: (row.total_orders, row.total_revenue)
             for row in reports.sales_channel(mixed).collect()}
    assert found == {"Online": (1, 200), "Loja Física": (1, 50)}


def test_status_report_keeps_everything(mixed):
    found = {row.status: (row.total_orders, row.total_revenue)
             for row in reports.order_status(mixed).collect()}
    assert found == {"Enviado": (2, 250), "Cancelado": (1, 100), None: (1, 100)}


def test_months_without_sales_are_zero(mixed):
    found = {row.order_month.month: row.monthly_revenue
             for row in reports.calendar_revenue(mixed).collect()}
    assert len(found) == 12
    assert found[3] == 200 and found[5] == 50 and found[4] == 0


def test_reason_shares(warehouse):
    tables = warehouse(
        salesorderheader=[header(1), header(2)],
        salesorderdetail=[line(1), line(1, detail=2), line(1, detail=3), line(2)],
        salesorderheadersalesreason=[{"salesorderid": 1, "salesreasonid": 1},
                                     {"salesorderid": 2, "salesreasonid": 2}])
    found = {row.reason: (row.occurrences, row.share_pct)
             for row in reports.reason_share(tables).collect()}
    assert len(found) == 7
    assert found["Preço"] == (3, 75) and found["Promoção"] == (1, 25) and found["TV"] == (0, 0)


def test_no_sales(warehouse):
    tables = warehouse(salesorderheader=[header(1, status=4)], salesorderdetail=[line(1)])
    row = reports.kpi_general(tables).first()
    assert (row.total_orders, row.total_customers, row.total_revenue) == (0, 0, None)
    assert reports.monthly_revenue(tables).count() == 0
    assert reports.top_products(tables).count() == 0


def test_top_products_breaks_ties_by_name_and_takes_unnamed_products(warehouse):
    tables = warehouse(
        salesorderheader=[header(1)],
        salesorderdetail=[line(1, productid=n) for n in range(1, 15)],
        product=[{"productid": n, "name": f"P{n:02}"} for n in range(2, 15)])
    rows = reports.top_products(tables).collect()
    assert [row.product_name for row in rows] == [None, *(f"P{n:02}" for n in range(2, 11))]


def test_reports_are_sorted(small):
    def column(report, name):
        return [row[name] for row in report(small).collect()]
    months = column(reports.monthly_revenue, "order_month")
    assert months == sorted(months)
    for report, name in ((reports.revenue_by_country, "total_revenue"),
                         (reports.revenue_by_category, "total_revenue"),
                         (reports.order_status, "total_orders"),
                         (reports.sellers_by_region, "total_orders")):
        values = column(report, name)
        assert values == sorted(values, reverse=True)


def test_fan_trap_totals(spark):
    """Known totals at sf0.01 over orders with a labelled status, cancelled ones included."""
    warehouse = Warehouse(spark, OrdersFeed(spark, MEDIUM))
    labelled = "statussales is not null"
    orders = order_sales(warehouse, "statussales", sales_only=False).where(labelled)
    assert orders.agg(F.sum(over_lines("totaldue"))).first()[0] == Decimal("12870901305.07")
    headers = warehouse.stg("stg_salesorderheader").where(labelled)
    assert headers.agg(F.sum("totaldue")).first()[0] == Decimal("3220017174.85")
    # Orders without lines are not in the fact.
    without_lines = headers.join(
        warehouse.stg("stg_salesorderdetail"), "salesorderid", "left_anti")
    assert (orders.agg(F.sum("totaldue")).first()[0]
            + without_lines.agg(F.sum("totaldue")).first()[0]) == Decimal("3220017174.85")


def test_customers_of_built_and_planned_tables(small, built):
    for name, report in CUSTOMER_REPORTS.items():
        assert rows_of(report(built)) == rows_of(report(small)), name
    planned = customers_by_month(built)._jdf.queryExecution().executedPlan().toString()
    assert "customer_bitmaps" in planned and "order_totals" not in planned


def test_customers_are_counted_once_however_bitmaps_are_united(spark, source):
    """Ids in several blocks, negative ones, unknown customers, orders without lines or a date."""
    ids = [-40000, -1, 0, 1, 32767, 32768, 32769, 10**9]
    headers = [{"salesorderid": n, "customerid": ids[n % 8], "status": 5,
                "orderdate": dt.datetime(2013, 1 + n % 4, 3), "onlineorderflag": n % 3 == 0}
               for n in range(40)]
    headers += [{"salesorderid": 50, "customerid": 77, "status": 5},
                {"salesorderid": 51, "customerid": 5, "status": 5}]
    lines = [{"salesorderid": n, "salesorderdetailid": n, "productid": 1, "orderqty": 1}
             for n in [*range(40), 50]]
    known = [{"customerid": one} for one in (*ids, 5)]
    tables = source(**{**BASE, "customer": known}, salesorderheader=headers,
                    salesorderdetail=lines)
    warehouse = Warehouse(spark, tables)
    assert customer_counts(warehouse, sales_only=False).first().customers == 8
    by_month = customer_counts(warehouse, "sales_month", sales_only=False).collect()
    assert {row.sales_month.month: row.customers for row in by_month} == dict.fromkeys(
        range(1, 5), 2)
    first = customer_counts(warehouse, months=F.month("sales_month") < 3, sales_only=False)
    assert first.first().customers == 4
    empty = Warehouse(spark, source(**BASE, salesorderheader=[], salesorderdetail=[]))
    assert customer_counts(empty).first().customers == 0
    assert customer_counts(empty, "sales_month").count() == 0
