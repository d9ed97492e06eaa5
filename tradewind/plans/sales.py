"""Narrow views of the order lines that the reports and the forecast are computed from.

``order_sales`` has one row per order with lines, ``product_sales`` one row per product and
``monthly_sales`` one row per series and month. Lines are totalled before they are shuffled or
joined, so that an order or product with very many lines shrinks to one row per task.

Built warehouses are read from their rollups or ``fact_sales``; otherwise the staging frames
are used with only the lookups the caller's columns need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import labels
from tradewind.functions.columns import month_start
from tradewind.plans import marts
from tradewind.plans.warehouse import MONTH, Warehouse


def is_sale() -> Column:
    """Orders that count as sales; an unknown status does not."""
    return ~F.col("statussales").isin(*labels.CLOSED_STATUSES)


# Product attributes that can split an order into several rows.
PRODUCT_COLUMNS = ("product_name", "productsubcategory_name", "productcategory_name")


def within(warehouse: Warehouse, rows: DataFrame, days: Column | None) -> DataFrame:
    """The rows whose ``orderdate`` is a day of the calendar that ``days`` holds for.

    Rows and calendar meet on the month as well. Where the rows are a built table its partitions
    are pruned by the months of those days.
    """
    if days is None:
        return rows
    calendar = warehouse.by_month("dim_dates").where(days).select(
        F.col("metric_date").alias("orderdate"), MONTH)
    return rows.join(calendar, ["orderdate", MONTH])


def order_sales(warehouse: Warehouse, *columns: str, sales_only: bool = True,
                split_by: str | None = None, days: Column | None = None) -> DataFrame:
    """One row per order that has lines, or per order and value of ``split_by``.

    Columns: ``salesorderid``, ``totaldue``, ``line_count``, ``quantity``, ``amount`` (paid for
    the lines) and the order-level fact columns named in ``columns``. A sum of an order value
    over lines is ``sum(value * line_count)``. ``sales_only`` drops cancelled, rejected and
    unknown states. ``split_by`` is one of ``PRODUCT_COLUMNS``. ``days`` is a condition on the
    columns of ``dim_dates`` that the order date has to meet.
    """
    wanted = tuple(dict.fromkeys((*columns, "totaldue", *(["statussales"] if sales_only else []),
                                  *([] if days is None else ["orderdate"]))))
    split = [split_by] if split_by else []
    condition = is_sale() if sales_only else None
    if warehouse.has("order_totals") and not split_by:
        totals = within(warehouse, _kept(warehouse.by_month("order_totals"), condition), days)
    elif warehouse.has("fact_sales"):
        lines = within(warehouse, _kept(warehouse.by_month("fact_sales"), condition), days)
        if split_by:
            products = warehouse.mart("dim_products").select(
                F.col("productsk").alias("productfk"), split_by)
            lines = lines.join(products, "productfk", "left")
        totals = (lines.groupBy("salesorderid", *wanted, *split)
                  .agg(*marts.line_totals(F.col("amountpaidproduct"))))
    else:
        totals = marts.order_totals(warehouse, wanted, condition=condition, split_by=split_by)
        if days is not None:
            totals = within(warehouse, totals.withColumn(MONTH, month_start("orderdate")), days)
    return totals.select("salesorderid", *dict.fromkeys((*columns, "totaldue")), *split,
                         "line_count", "quantity", "amount")


def _kept(rows: DataFrame, condition: Column | None) -> DataFrame:
    return rows if condition is None else rows.where(condition)


def over_lines(value: str) -> Column:
    """An order value counted once per line of the order."""
    return F.col(value) * F.col("line_count").cast("decimal(12,0)")


def customer_sales(warehouse: Warehouse) -> DataFrame:
    """One row per customer with sales: ``customerfk`` (NULL if unknown) and totals.

    Totals: ``order_count``, ``quantity``, ``amount``; the order totals counted once per line
    (``line_revenue`` over ``line_values`` lines) and once per order (``order_revenue`` over
    ``order_values`` orders).
    """
    totals = [
        F.count("salesorderid").alias("order_count"),
        F.sum("quantity").alias("quantity"),
        F.sum("amount").alias("amount"),
        F.sum(over_lines("totaldue")).alias("line_revenue"),
        F.sum(F.when(F.col("totaldue").isNotNull(), F.col("line_count"))).alias("line_values"),
        F.sum("totaldue").alias("order_revenue"),
        F.count("totaldue").alias("order_values")]
    if warehouse.has("fact_sales"):
        return order_sales(warehouse, "customerfk").groupBy("customerfk").agg(*totals)
    per_customer = order_sales(warehouse, "customerid").groupBy("customerid").agg(*totals)
    return marts.look_up_customers(warehouse, per_customer)


def person_types(warehouse: Warehouse) -> DataFrame:
    """``customerfk`` and person type of the customers that ordered, and maybe of others."""
    if warehouse.has("dim_customers"):
        customers = warehouse.mart("dim_customers")
        return customers.select(F.col("customersk").alias("customerfk"), "customerpersontype")
    return marts.customer_person_types(warehouse)


def monthly_sales(warehouse: Warehouse, series: str | None = None, *,
                  customers: bool = True, days: Column | None = None) -> DataFrame:
    """Monthly totals of all orders within the calendar, cancelled ones included.

    ``series`` names an order-level fact column or one of ``PRODUCT_COLUMNS``; each of its
    values becomes a series. Without it there is one series, ``all``. ``customers=False``
    leaves out ``unique_customers`` and the customer lookup. ``days`` narrows the calendar, see
    :func:`order_sales`.
    """
    of_product = series in PRODUCT_COLUMNS
    key = F.lit("all") if series is None else F.col(series).cast("string")
    columns = ["orderdate", *(["customerfk"] if customers else []),
               *([series] if series and not of_product else [])]
    rows = order_sales(warehouse, *columns, sales_only=False,
                       split_by=series if of_product else None, days=days)
    unique = [F.count_distinct("customerfk").alias("unique_customers")] if customers else []
    revenue = F.sum(over_lines("totaldue"))
    lines = F.sum(F.when(F.col("totaldue").isNotNull(), F.col("line_count")))
    if days is None:
        calendar = warehouse.mart("dim_dates").select(F.col("metric_date").alias("orderdate"))
        rows = rows.join(calendar, "orderdate")
    return (rows.groupBy(key.alias("series_key"), month_start("orderdate").alias("order_month"))
            .agg(F.count("salesorderid").alias("total_orders"),
                 revenue.alias("total_revenue"),
                 F.sum("quantity").alias("total_qty"),
                 *unique,
                 (revenue.cast("double") / lines).alias("avg_order_value")))


def product_sales(warehouse: Warehouse) -> DataFrame:
    """Sold quantity, amount and cost per product, with the product's names."""
    if warehouse.has("fact_sales"):
        totals = (warehouse.mart("product_totals").where(is_sale())
                  .groupBy(F.col("productfk").alias("productsk"))
                  .agg(*(F.sum(name).alias(name) for name in ("quantity", "amount", "cost"))))
        named = totals.join(warehouse.mart("dim_products"), "productsk")
    else:
        sales = (warehouse.stg("stg_salesorderheader").where(is_sale()).select("salesorderid"))
        totals = (warehouse.stg("stg_salesorderdetail").where(F.col("productid").isNotNull())
                  .select("salesorderid", "productid", "orderqty",
                          marts.line_amount().alias("amountpaidproduct"))
                  .join(sales, "salesorderid", "left_semi")
                  .groupBy("productid")
                  .agg(F.sum("orderqty").alias("quantity"),
                       F.sum("amountpaidproduct").alias("amount")))
        named = (totals.join(marts.product_attributes(warehouse), "productid", "left")
                 .withColumn("cost", F.col("quantity") * F.col("standardcost")))
    return named.select("productid", "product_name", "productsubcategory_name",
                        "productcategory_name", "quantity", "amount", "cost")
