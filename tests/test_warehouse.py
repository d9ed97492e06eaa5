"""Building, reopening, catalog tables, SQL access and the source gate."""

import re

import pytest

from conftest import SMALL, rows_of
from test_marts import BASE, header, line
from tradewind import Warehouse, build_warehouse, run_query
from tradewind.operators.lineage import CLEANUP_SETTING
from tradewind.operators.quality import run_checks
from tradewind.plans import reports
from tradewind.plans.checks import MART_CHECKS
from tradewind.plans.marts import MARTS, ROLLUPS, product_totals
from tradewind.plans.staging import STAGING
from tradewind.plans.warehouse import SourceCheckError, _laid_out
from tradewind.sources.feed import FEED, OrdersFeed
from tradewind.sources.tables import TABLES, CatalogSource, ParquetSource
from tradewind.sources.versions import Versions


def test_built_tables_equal_lazy_marts(small, built):
    for name in MARTS:
        assert built.has(name) and not small.has(name)
        assert built.mart(name).dtypes == small.mart(name).dtypes
        assert rows_of(built.mart(name)) == rows_of(small.mart(name)), name


def test_order_totals_add_up_to_the_fact(built):
    fact, totals = built.mart("fact_sales"), built.mart("order_totals")
    assert totals.count() == fact.select("salesorderid").distinct().count()
    sums = totals.selectExpr("sum(line_count)", "sum(quantity)", "sum(amount)").first()
    assert tuple(sums) == tuple(
        fact.selectExpr("count(*)", "sum(orderqty)", "sum(amountpaidproduct)").first())


def test_reports_without_the_rollup_use_the_fact(built):
    tables = {name: built.mart(name) for name in MARTS}
    plain = Warehouse(built.spark, tables=tables)
    for report in (reports.kpi_general, reports.sales_reasons, reports.order_status,
                   reports.top_products, reports.revenue_by_category):
        assert rows_of(report(plain)) == rows_of(report(built))


def test_built_warehouse_has_no_staging(built):
    with pytest.raises(LookupError):
        built.stg("stg_store")


def test_rebuild_replaces_tables(spark, source, tmp_path):
    location = str(tmp_path)
    for orders in (2, 1):
        tables = source(**BASE, salesorderheader=[header(n) for n in range(orders)],
                        salesorderdetail=[line(n) for n in range(orders)])
        build = build_warehouse(spark, tables, location)
        assert build.warehouse.mart("fact_sales").count() == orders
        assert build.report.where("not passed and model = 'fact_sales'").count() == 0


def test_readers_keep_their_version_until_it_is_removed(spark, source, tmp_path):
    location = str(tmp_path)
    orders = [source(**BASE, salesorderheader=[header(n) for n in range(count)],
                     salesorderdetail=[line(n) for n in range(count)]) for count in (3, 2, 1)]
    first = build_warehouse(spark, orders[0], location).version
    reader = Warehouse.open(spark, location)
    second = build_warehouse(spark, orders[1], location).version
    assert reader.mart("fact_sales").count() == 3
    assert Warehouse.open(spark, location).mart("fact_sales").count() == 2
    assert Warehouse.open(spark, location, version=first).mart("fact_sales").count() == 3
    versions = Versions(spark, location)
    third = build_warehouse(spark, orders[2], location).version
    assert [row.version for row in versions.published()] == [third, second, first]
    assert versions.remove_old(keep=2) == [first]
    assert [row.version for row in versions.published()] == [third, second]
    assert not (tmp_path / first).exists() and (tmp_path / second).exists()
    with pytest.raises(LookupError):
        Warehouse.open(spark, location, version=first)
    assert versions.remove_old() == [second]
    assert Warehouse.open(spark, location).mart("fact_sales").count() == 1


def test_readers_see_the_set_before_while_a_build_runs_or_fails(spark, source, tmp_path,
                                                                monkeypatch):
    location = str(tmp_path)
    tables = source(**BASE, salesorderheader=[header(1)], salesorderdetail=[line(1)])
    version = build_warehouse(spark, tables, location).version
    seen = []

    def broken(warehouse):
        seen.append(Warehouse.open(spark, location).mart("fact_sales").count())
        assert len([path for path in tmp_path.iterdir() if path.name != "manifest"]) == 2
        raise RuntimeError("lost")

    monkeypatch.setitem(ROLLUPS, "product_totals", broken)
    with pytest.raises(RuntimeError, match="lost"):
        build_warehouse(spark, tables, location)
    assert seen == [1]
    assert {path.name for path in tmp_path.iterdir()} == {"manifest", version}
    assert Versions(spark, location).find().version == version


def test_nothing_is_open_before_the_first_build(spark, tmp_path):
    with pytest.raises(LookupError):
        Warehouse.open(spark, str(tmp_path / "nowhere"))
    assert Versions(spark, str(tmp_path / "nowhere")).published() == []


def test_empty_tables_can_be_built(spark, source, tmp_path):
    build = build_warehouse(spark, source(**BASE, salesorderheader=[], salesorderdetail=[]),
                            str(tmp_path))
    assert build.warehouse.mart("fact_sales").count() == 0
    assert Warehouse.open(spark, str(tmp_path)).mart("order_totals").count() == 0


def test_nulls_are_counted_while_writing(spark, source, tmp_path):
    """The same counts as from a second scan, also for rows without an order date."""
    tables = source(**BASE, salesorderheader=[header(1), header(2, orderdate=None)],
                    salesorderdetail=[line(1), line(2), line(3)])
    build = build_warehouse(spark, tables, str(tmp_path))
    checks = {name: checks.only("not_null") for name, checks in MART_CHECKS.items()}
    expected = run_checks(build.warehouse.mart, checks)
    found = build.report.where("test = 'not_null'")
    assert rows_of(found) == rows_of(expected)
    assert found.where("column_name = 'orderdate'").first().failures == 2
    assert "Scan parquet" not in found._jdf.queryExecution().executedPlan().toString()


def test_repeated_source_key_stops_the_build(spark, source, tmp_path):
    tables = source(**(BASE | {"customer": BASE["customer"] * 2}))
    with pytest.raises(SourceCheckError, match=r"stg_customer.customerid \(unique\)"):
        build_warehouse(spark, tables, str(tmp_path))
    assert not list(tmp_path.iterdir())


def test_catalog_tables(spark, source):
    spark.sql("CREATE DATABASE IF NOT EXISTS sales_marts")
    tables = source(**BASE, salesorderheader=[header(1)], salesorderdetail=[line(1)])
    build_warehouse(spark, tables, "catalog:sales_marts")
    assert spark.table("sales_marts.fact_sales").count() == 1
    assert Warehouse.open(spark, "catalog:sales_marts").mart("dim_products").count() == 1
    more = source(**BASE, salesorderheader=[header(1), header(2)],
                  salesorderdetail=[line(1), line(2)])
    reader = Warehouse.open(spark, "catalog:sales_marts")
    build_warehouse(spark, more, "catalog:sales_marts")
    assert reader.mart("fact_sales").count() == 1
    assert spark.table("sales_marts.fact_sales").count() == 2
    assert len(Versions(spark, "catalog:sales_marts").remove_old()) == 1
    assert Warehouse.open(spark, "catalog:sales_marts").mart("fact_sales").count() == 2


def test_sources_from_folders_and_catalog(spark, source, tmp_path):
    literal = source(**BASE)
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_person")
    for schema, name in TABLES:
        literal.table(schema, name).write.parquet(f"{tmp_path}/{schema}/{name}")
    literal.table("person", "person").write.mode("overwrite").saveAsTable("raw_person.person")

    folders = Warehouse(spark, ParquetSource(spark, str(tmp_path)))
    direct = Warehouse(spark, literal)
    for name in STAGING:
        assert rows_of(folders.stg(name)) == rows_of(direct.stg(name))
    catalog = Warehouse(spark, CatalogSource(spark, {"person": "raw_person"}))
    assert rows_of(catalog.stg("stg_person")) == rows_of(direct.stg("stg_person"))
    with pytest.raises(KeyError):
        CatalogSource(spark).table("person", "nobody")


def test_feed_covers_every_source_column(spark):
    assert set(FEED) == set(TABLES)
    feed = OrdersFeed(spark, SMALL)
    for (schema, name), columns in TABLES.items():
        expected = spark.createDataFrame([], columns).schema
        found = feed.table(schema, name).schema
        assert found.names == expected.names
        for field in expected:
            kind = found[field.name].dataType.simpleString().replace("_ntz", "")
            assert kind == field.dataType.simpleString(), (name, field.name)


def test_sql_over_views(small, spark):
    small.register_views()
    result = run_query(spark, """
        SELECT dp.productcategory_name AS Category, COUNT(*) AS LineCount
        FROM fact_sales fs JOIN dim_products dp ON fs.productfk = dp.productsk
        GROUP BY 1""")
    assert result.columns == ["category", "linecount"]
    assert sum(row.linecount for row in result.collect()) == small.mart("fact_sales").count()
    assert spark.table("stg_store").count() == small.stg("stg_store").count()


def test_sql_gives_the_same_as_a_report(built):
    built.register_views()
    found = run_query(built.spark, """
        SELECT countryregion_name AS Country, CAST(ROUND(SUM(totaldue), 2) AS DECIMAL(38, 2))
                   AS Total_Revenue, COUNT(DISTINCT salesorderid) AS Total_Orders
        FROM fact_sales
        WHERE statussales NOT IN ('Cancelado', 'Rejeitado') AND countryregion_name IS NOT NULL
        GROUP BY 1 ORDER BY 2 DESC""")
    assert found.collect() == reports.revenue_by_country(built).collect()


def test_partitioned_tables_are_dealt_before_their_keys_are_made(small):
    for name in ("fact_sales", "order_totals"):
        text = _laid_out(name, small)._jdf.queryExecution().executedPlan().toString()
        dealt = text.index("REBALANCE_PARTITIONS")
        assert "md5(" in text[:dealt], name  # a plan is printed from its end


def test_tables_are_written_with_zstd(small, tmp_path):
    build_warehouse(small.spark, small.source, str(tmp_path))
    files = list(tmp_path.glob("v*/dim_products/*.parquet"))
    assert files and all(".zstd." in file.name for file in files)


def test_shuffle_files_go_with_each_write_of_a_build(spark, source, tmp_path, monkeypatch):
    before = spark.conf.get(CLEANUP_SETTING, None)
    seen = []

    def totals(warehouse):
        seen.append(spark.conf.get(CLEANUP_SETTING))
        return product_totals(warehouse)

    monkeypatch.setitem(ROLLUPS, "product_totals", totals)
    build_warehouse(spark, source(**BASE, salesorderheader=[header(1)],
                                  salesorderdetail=[line(1)]), str(tmp_path))
    assert seen == ["true"] and spark.conf.get(CLEANUP_SETTING, None) == before


def test_the_checks_of_a_build_shuffle_hashes_of_the_fact(spark, source, tmp_path):
    build = build_warehouse(spark, source(**BASE, salesorderheader=[header(1)],
                                          salesorderdetail=[line(1)]), str(tmp_path))
    text = build.report._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(hash#" in text


def test_product_totals_are_dealt_by_packed_keys(built):
    text = product_totals(built)._jdf.queryExecution().executedPlan().toString()
    assert "unhex(" in text and not re.search(r"Exchange hashpartitioning\(productfk#", text)
