"""How many different customers bought, by any of the rollup's attributes.

Distinct counts can't be added up: a customer of two months is one customer of the quarter. The
rollup ``customer_bitmaps`` keeps the customers of each month, country, channel and kind of order
as bitmaps, which can be united, so one small table answers for every combination exactly. A report
unites bitmaps map-side and never shuffles or sorts customer ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import labels
from tradewind.plans.warehouse import Warehouse


def customer_counts(warehouse: Warehouse, *by: Column | str, sales_only: bool = True,
                    months: Column | None = None) -> DataFrame:
    """The columns ``by`` and ``customers``, the number of different known customers.

    ``by`` are ``marts.BITMAP_COLUMNS`` or named expressions of them. ``sales_only`` drops cancelled, rejected
    and unknown states; ``months`` is a condition on ``sales_month``. Without ``by`` there is one
    row. Groups without a known customer have no row.
    """
    rows = warehouse.mart("customer_bitmaps")
    if sales_only:
        rows = rows.where("is_sale")
    if months is not None:
        rows = rows.where(months)
    named = rows.select(*by, F.col("block").alias("_block"), F.col("bitmap").alias("_bitmap"))
    names = named.columns[:-2]
    united = named.groupBy(*names, "_block").agg(
        F.bitmap_count(F.bitmap_or_agg("_bitmap")).alias("_customers"))
    total = F.coalesce(F.sum("_customers"), F.lit(0)).alias("customers")
    return united.groupBy(*names).agg(total)


def customers_total(warehouse: Warehouse) -> DataFrame:
    """All customers with sales."""
    return customer_counts(warehouse)


def customers_by_month(warehouse: Warehouse) -> DataFrame:
    """Customers of each month of all orders, cancelled ones included."""
    return customer_counts(warehouse, F.col("sales_month").alias("order_month"),
                           sales_only=False)


def customers_by_country(warehouse: Warehouse) -> DataFrame:
    return customer_counts(warehouse, F.col("countryregion_name").alias("country"))


def customers_by_channel(warehouse: Warehouse) -> DataFrame:
    channel = (F.when(F.col("onlineorderflag"), labels.ONLINE_CHANNEL)
               .otherwise(labels.STORE_CHANNEL))
    return customer_counts(warehouse, channel.alias("channel"))


def customers_by_quarter_and_country(warehouse: Warehouse) -> DataFrame:
    """Customers of each quarter and country; those of several months count once."""
    return customer_counts(
        warehouse, F.year("sales_month").alias("year"), F.quarter("sales_month").alias("quarter"),
        F.col("countryregion_name").alias("country"))


CUSTOMER_REPORTS = {report.__name__: report for report in (
    customers_total, customers_by_month, customers_by_country, customers_by_channel,
    customers_by_quarter_and_country)}
