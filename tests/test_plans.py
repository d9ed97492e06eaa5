"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from conftest import SMALL, rows_of
from test_marts import BASE, header, line
from tradewind.plans import marts, reports
from tradewind.plans.sales import monthly_sales
from tradewind.plans.warehouse import Warehouse

LAZY = [name for name in registry.oracle_sql() if name != "dq_report"]


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python(name, spark):
    text = plan(registry.queries()[name](spark, SMALL))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval",
                     "MapInPandas", "FlatMapGroups"):
        assert operator not in text


def columns_read(text, table):
    return {column for found in re.findall(
        rf"FileScan parquet \[([^\]]*)\][^\n]*{table}\.parquet", text)
        for column in re.sub(r"#\d+L?", "", found).split(",")}


def test_scans_read_only_what_is_needed(small):
    text = plan(reports.monthly_revenue(small))
    assert columns_read(text, "lineitem") == {"l_orderkey"}
    assert columns_read(text, "orders") == {"o_orderkey", "o_orderdate", "o_totalprice"}
    assert "customer.parquet" not in text and "part.parquet" not in text
    assert "PushedFilters: [IsNotNull(l_partkey)" in plan(reports.top_products(small))


def test_lines_are_totalled_before_the_shuffle(small):
    text = plan(reports.kpi_general(small))
    partial = text.index("partial_sum(orderqty")
    assert text.rindex("Exchange hashpartitioning", 0, partial) > 0


def test_top_products_keeps_only_the_top_rows(small):
    assert "TakeOrderedAndProject(limit=10" in plan(reports.top_products(small))


def test_built_report_reads_few_columns(built):
    text = plan(reports.revenue_by_country(built))
    read = re.search(r"FileScan parquet \[([^\]]*)\]", text)[1]
    assert set(re.sub(r"#\d+L?", "", read).split(",")) == {
        "salesorderid", "statussales", "totaldue", "countryregion_name", "line_count",
        "order_month"}  # the name of the partition, which no file holds
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text)[1]
    assert "In(statussales, [Cancelado,Rejeitado])" in pushed
    assert "IsNotNull(countryregion_name)" in pushed


@pytest.mark.parametrize("report", [
    reports.revenue_by_country, reports.monthly_revenue, reports.sales_reasons,
    reports.order_status, reports.kpi_general, reports.customer_profile])
def test_built_order_reports_do_not_touch_the_lines(report, built):
    text = plan(report(built))
    assert "fact_sales" not in text and "order_totals" in text
    assert "hashpartitioning(salesorderid" not in text


@pytest.mark.parametrize("report", [reports.top_products, reports.revenue_by_category])
def test_built_product_reports_read_the_product_rollup(report, built):
    text = plan(report(built))
    assert "fact_sales" not in text and "product_totals" in text


@pytest.mark.parametrize("report", [
    reports.monthly_revenue, reports.quarterly_revenue, reports.calendar_revenue,
    lambda warehouse, days: monthly_sales(warehouse, "product_name", days=days)])
def test_conditions_on_days_prune_partitions(report, built, small):
    days = (F.col("metric_year") == 1995) & (F.col("metric_quarter") == 2)
    found = report(built, days=days)
    filters = re.findall(r"PartitionFilters: \[([^\n]*)\], PushedFilters", plan(found))
    assert any("dynamicpruning" in pruned and "order_month" in pruned for pruned in filters)
    assert rows_of(found) == rows_of(report(small, days=days)) != []


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def test_without_broadcasts_the_hot_order_join_is_still_salted(no_broadcast, small):
    text = plan(small.mart("fact_sales"))
    assert re.search(r"SortMergeJoin \[line_salesorderid#\w+, _part#\w+\]", text)
    # Only the counted hot keys are broadcast.
    assert text.count("BroadcastHashJoin") == 2


def shuffles(text, *columns):
    keys = ", ".join(rf"{column}#\w+" for column in columns)
    return len(re.findall(rf"Exchange hashpartitioning\({keys}, \d+\)", text))


def test_reports_without_broadcasts_do_not_join_at_line_grain(no_broadcast, small):
    text = plan(reports.revenue_by_country(small))
    assert "Broadcast" not in text
    # Lines, totalled on the way, and orders are each shuffled once by order id.
    assert shuffles(text, "salesorderid") == 2


def test_checked_keys_save_the_distinct_shuffles(no_broadcast, small):
    def count(warehouse):
        return plan(warehouse.mart("fact_sales")).count("Exchange hashpartitioning")
    checked = Warehouse(small.spark, small.source, keys_checked=True)
    # Orders, customers, products, addresses, states, countries and territories.
    assert count(small) - count(checked) == 7


def test_adaptive_execution_splits_a_hot_customer_and_product(no_broadcast, spark, source):
    tables = source(
        **(BASE | {"customer": [{"customerid": n} for n in range(40)],
                   "product": [{"productid": n} for n in range(40)]}),
        salesorderheader=[header(n, customerid=1 if n % 2 else n % 40) for n in range(3000)],
        salesorderdetail=[line(n, productid=1 if n % 2 else n % 40) for n in range(3000)])
    for name in ("salesorderheader", "salesorderdetail"):
        tables.frames[name] = tables.frames[name].repartition(12)
    rows = marts.fact_sales(Warehouse(spark, tables))
    assert len(rows.collect()) == 3000
    text = plan(rows)
    assert re.search(r"SortMergeJoin\(skew=true\) \[productid", text)
    assert re.search(r"SortMergeJoin\(skew=true\) \[customerid", text)


def test_adaptive_execution_splits_a_hot_order_and_address(no_broadcast, spark, source):
    tables = source(
        **(BASE | {"address": [{"addressid": n, "stateprovinceid": 5} for n in range(40)]}),
        salesorderheader=[header(n, billtoaddressid=1 if n % 2 else n % 40)
                          for n in range(3000)],
        salesorderdetail=[line(1 if n % 2 else n, productid=n % 50) for n in range(3000)])
    for name in ("salesorderheader", "salesorderdetail"):
        tables.frames[name] = tables.frames[name].repartition(12)
    warehouse = Warehouse(spark, tables)
    products = reports.top_products(warehouse)
    assert sum(row.total_qty for row in products.collect()) > 0
    assert re.search(r"SortMergeJoin\(skew=true\) \[salesorderid[^\n]*LeftSemi", plan(products))

    countries = reports.revenue_by_country(Warehouse(spark, source(
        **(BASE | {"address": [{"addressid": n, "stateprovinceid": 5} for n in range(40)]}),
        salesorderheader=[header(n, billtoaddressid=1 if n % 2 else n % 40)
                          for n in range(3000)],
        salesorderdetail=[line(n) for n in range(3000)])))
    assert countries.collect()[0].total_orders == 3000
    assert re.search(r"SortMergeJoin\(skew=true\) \[billtoaddressid", plan(countries))


def test_no_shuffle_of_the_fact_carries_a_hash(no_broadcast, small):
    found = Warehouse(small.spark, small.source, keys_checked=True).mart("fact_sales")
    text = found._jdf.queryExecution().executedPlan().toString()
    # Keys and amounts are made above the last join; below it only natural keys travel.
    last = text.index("SortMergeJoin [line_salesorderid")
    assert "md5" in text[:last] and "md5" not in text[last:]


def test_orders_are_not_shuffled_again_for_their_reasons(no_broadcast, small):
    # Lines, orders and reasons are dealt by order and part once each.
    text = plan(small.mart("fact_sales"))
    dealt = re.findall(r"Exchange hashpartitioning\(\w+#\w+, _(?:right_)?part#\w+, \d+\)", text)
    assert len(dealt) == 3


def test_lookups_of_the_fact_shuffle_only_the_ids_of_orders(no_broadcast, small):
    text = plan(small.mart("fact_sales"))
    for key in ("customerid", "billtoaddressid"):
        below = text[text.index(f"Exchange hashpartitioning({key}#"):]
        read = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*orders\.parquet", below)[1]
        assert set(re.sub(r"#\d+L?", "", read).split(",")) == {"o_orderkey", "o_custkey"}


def test_reasons_are_gathered_as_ids(no_broadcast, small):
    text = plan(small.mart("dim_reasons"))
    links = text[:text.index("lineitem.parquet")]
    gathered = links[links.rindex("partial_collect_set("):].split("\n")[0]
    assert gathered.startswith("partial_collect_set(CASE WHEN known") and "name" not in gathered
