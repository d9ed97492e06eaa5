"""Business reports on the sales warehouse.

Each report takes a :class:`Warehouse` and returns a DataFrame. Revenue of the line-grain
reports counts an order's total once per line, as the line-grain fact does; the
``*_order_grain`` reports count it once per order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions import labels
from tradewind.functions.columns import money, month_start
from tradewind.plans.sales import (
    customer_sales,
    order_sales,
    over_lines,
    person_types,
    product_sales,
)
from tradewind.plans.warehouse import Warehouse

REVENUE_PER_LINE = "line"
REVENUE_PER_ORDER = "order"


def _revenue(grain: str) -> Column:
    return F.sum(over_lines("totaldue") if grain == REVENUE_PER_LINE else F.col("totaldue"))


def _order_count(name: str) -> Column:
    # One row per order, so counting ids is counting orders.
    return F.count("salesorderid").alias(name)


def _channel() -> Column:
    return (F.when(F.col("onlineorderflag"), labels.ONLINE_CHANNEL)
            .otherwise(labels.STORE_CHANNEL))


# --- key figures ----------------------------------------------------------------------

def kpi_general(warehouse: Warehouse, grain: str = REVENUE_PER_LINE) -> DataFrame:
    """Orders, customers, revenue, average order value, line revenue, items."""
    revenue, values = F.sum(f"{grain}_revenue"), F.sum(f"{grain}_values")
    # One row per customer, so counting keys is counting customers.
    return customer_sales(warehouse).agg(
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("total_orders"),
        F.count("customerfk").alias("total_customers"),
        money(revenue).alias("total_revenue"),
        money(revenue / values).alias("avg_order_value"),
        money(F.sum("amount")).alias("total_product_revenue"),
        F.sum("quantity").alias("total_items_sold"))


def online_share(warehouse: Warehouse) -> DataFrame:
    """Share of orders placed online, in percent."""
    online = F.count_if(F.col("onlineorderflag"))
    return order_sales(warehouse, "onlineorderflag").agg(
        online.alias("online_orders"),
        _order_count("total_orders"),
        money(100 * online / F.count("salesorderid")).alias("online_pct"))


def countries_served(warehouse: Warehouse) -> DataFrame:
    return order_sales(warehouse, "countryregion_name").agg(
        F.count_distinct("countryregion_name").alias("countries"))


# --- time -----------------------------------------------------------------------------

# Reports by time take a condition on the columns of dim_dates, ``days``; on built tables it prunes
# the months that are read.

def monthly_revenue(warehouse: Warehouse, grain: str = REVENUE_PER_LINE,
                    days: Column | None = None) -> DataFrame:
    return (order_sales(warehouse, "orderdate", days=days)
            .groupBy(month_start("orderdate").alias("order_month"))
            .agg(money(_revenue(grain)).alias("monthly_revenue"),
                 _order_count("monthly_orders"))
            .orderBy(F.col("order_month").asc_nulls_last()))


def quarterly_revenue(warehouse: Warehouse, days: Column | None = None) -> DataFrame:
    year, quarter = F.year("orderdate"), F.quarter("orderdate")
    return (order_sales(warehouse, "orderdate", days=days)
            .groupBy(year.alias("year"), quarter.alias("quarter"))
            .agg(money(_revenue(REVENUE_PER_LINE)).alias("quarterly_revenue"))
            .select("year", "quarter",
                    F.concat(F.lit("Q"), F.col("quarter").cast("string"), F.lit(" "),
                             F.col("year").cast("string")).alias("period"),
                    "quarterly_revenue")
            .orderBy("year", "quarter"))


def calendar_revenue(warehouse: Warehouse, days: Column | None = None) -> DataFrame:
    """Monthly revenue over the calendar, with zeros for months without sales."""
    calendar = warehouse.mart("dim_dates")
    months = ((calendar if days is None else calendar.where(days))
              .select(month_start("metric_date").alias("order_month")).distinct())
    zero = F.lit(0).cast("decimal(38,2)")
    return (months.join(monthly_revenue(warehouse, days=days), "order_month", "left")
            .select("order_month",
                    F.coalesce("monthly_revenue", zero).alias("monthly_revenue"),
                    F.coalesce("monthly_orders", F.lit(0)).alias("monthly_orders"))
            .orderBy("order_month"))


# --- products -------------------------------------------------------------------------

def top_products(warehouse: Warehouse, limit: int = 10) -> DataFrame:
    """Best-selling product names by amount paid; ties in name order."""
    names = [F.col("product_name"), F.col("productsubcategory_name").alias("subcategory"),
             F.col("productcategory_name").alias("category")]
    return (product_sales(warehouse).groupBy(*names)
            .agg(money(F.sum("amount")).alias("total_revenue"),
                 F.sum("quantity").alias("total_qty"))
            .orderBy(F.col("total_revenue").desc_nulls_first(), "product_name", "subcategory",
                     "category")
            .limit(limit))


def revenue_by_category(warehouse: Warehouse) -> DataFrame:
    amount, cost = F.sum("amount"), F.sum("cost")
    return (product_sales(warehouse).where(F.col("productcategory_name").isNotNull())
            .groupBy(F.col("productcategory_name").alias("category"))
            .agg(money(amount).alias("total_revenue"),
                 money(cost).alias("total_cost"),
                 money(amount - cost).alias("gross_profit"))
            .orderBy(F.col("total_revenue").desc_nulls_first(), "category"))


# --- places, channels, states ---------------------------------------------------------

def revenue_by_country(warehouse: Warehouse, grain: str = REVENUE_PER_LINE) -> DataFrame:
    return (order_sales(warehouse, "countryregion_name")
            .where(F.col("countryregion_name").isNotNull())
            .groupBy(F.col("countryregion_name").alias("country"))
            .agg(money(_revenue(grain)).alias("total_revenue"), _order_count("total_orders"))
            .orderBy(F.col("total_revenue").desc_nulls_first(), "country"))


def sales_channel(warehouse: Warehouse, grain: str = REVENUE_PER_LINE) -> DataFrame:
    return (order_sales(warehouse, "onlineorderflag")
            .groupBy(_channel().alias("channel"))
            .agg(_order_count("total_orders"), money(_revenue(grain)).alias("total_revenue")))


def order_status(warehouse: Warehouse) -> DataFrame:
    """All orders by state, cancelled, rejected and unknown ones included."""
    return (order_sales(warehouse, "statussales", sales_only=False)
            .groupBy(F.col("statussales").alias("status"))
            .agg(_order_count("total_orders"),
                 money(_revenue(REVENUE_PER_LINE)).alias("total_revenue"))
            .orderBy(F.col("total_orders").desc(), "status"))


# --- reasons --------------------------------------------------------------------------

def sales_reasons(warehouse: Warehouse) -> DataFrame:
    """Lines of orders that name each reason, in one row."""
    return order_sales(warehouse, *labels.REASON_FLAGS).agg(
        *(F.sum(F.col(flag) * F.col("line_count")).alias(f"{flag}_count")
          for flag in labels.REASON_FLAGS))


def reasons_long(warehouse: Warehouse) -> DataFrame:
    """The reason counts as (reason, occurrences) rows."""
    counts = sales_reasons(warehouse).select(
        *(F.col(f"{flag}_count").alias(label)
          for flag, (_, label) in labels.REASON_FLAGS.items()))
    return counts.unpivot([], counts.columns, "reason", "occurrences")


# --- people ---------------------------------------------------------------------------

def sellers_by_region(warehouse: Warehouse) -> DataFrame:
    return (warehouse.mart("fact_aggsalessellersregion")
            .groupBy(F.col("countryregion_name").alias("country"), "gender", "jobtitle")
            .agg(F.sum("totalsalesorders").alias("total_orders"))
            .orderBy(F.col("total_orders").desc(), "country", "gender", "jobtitle"))


def sellers_country_gender(warehouse: Warehouse) -> DataFrame:
    return (sellers_by_region(warehouse).groupBy("country", "gender")
            .agg(F.sum("total_orders").alias("total_orders"))
            .orderBy(F.col("total_orders").desc(), "country", "gender"))


def customer_profile(warehouse: Warehouse) -> DataFrame:
    """Orders, revenue and customers per person type.

    Totalled per customer first, so the customer lookup meets one row per customer.
    """
    return (customer_sales(warehouse).join(person_types(warehouse), "customerfk")
            .groupBy("customerpersontype")
            .agg(F.sum("order_count").alias("total_orders"),
                 F.count("customerfk").alias("total_customers"),
                 money(F.sum("line_revenue")).alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc_nulls_first(), "customerpersontype"))


# --- shares ---------------------------------------------------------------------------

def _with_share(report: DataFrame, value: str) -> DataFrame:
    # At most a handful of rows: one per channel, reason or state.
    total = F.sum(value).over(Window.partitionBy())
    return report.withColumn("share_pct", money(100 * F.col(value) / total))


def channel_share(warehouse: Warehouse) -> DataFrame:
    return _with_share(sales_channel(warehouse).select("channel", "total_revenue"),
                       "total_revenue")


def reason_share(warehouse: Warehouse) -> DataFrame:
    return _with_share(reasons_long(warehouse), "occurrences")


def status_share(warehouse: Warehouse) -> DataFrame:
    return _with_share(order_status(warehouse).select("status", "total_orders"), "total_orders")


# --- each order counted once ----------------------------------------------------------

def kpi_order_grain(warehouse: Warehouse) -> DataFrame:
    return kpi_general(warehouse, REVENUE_PER_ORDER)


def monthly_order_grain(warehouse: Warehouse) -> DataFrame:
    return monthly_revenue(warehouse, REVENUE_PER_ORDER)


def country_order_grain(warehouse: Warehouse) -> DataFrame:
    return revenue_by_country(warehouse, REVENUE_PER_ORDER)


def channel_order_grain(warehouse: Warehouse) -> DataFrame:
    return sales_channel(warehouse, REVENUE_PER_ORDER)


REPORTS = {report.__name__: report for report in (
    kpi_general, monthly_revenue, top_products, revenue_by_country, sales_channel,
    sales_reasons, order_status, sellers_by_region, revenue_by_category, quarterly_revenue,
    online_share, countries_served, sellers_country_gender, reasons_long, channel_share,
    reason_share, status_share, customer_profile, calendar_revenue, kpi_order_grain,
    monthly_order_grain, country_order_grain, channel_order_grain)}
