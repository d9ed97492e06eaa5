"""Marts: six dimensions, the order-line fact and the sales-force aggregate.

Source tables declare a unique key each, so a lookup by such a key does not multiply rows; a
build checks the keys first and then needs no DISTINCT over them. Surrogate keys are hashes of
natural keys, so a foreign key is computed next to its natural key wherever the dimension
holds every key in use; only the customer reference needs a lookup, as it is NULL for unknown
customers.

No lookup here carries a broadcast hint: small ones are broadcast when Spark measures them
below ``spark.sql.autoBroadcastJoinThreshold`` and shuffled otherwise.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import labels
from tradewind.functions.columns import (
    foreign_key,
    month_start,
    packed,
    surrogate_key,
    translate,
    unpacked,
)
from tradewind.operators.joins import (
    ROWS_PER_SPLIT,
    hot_keys,
    key_counts,
    left_join_nullable,
    left_join_parts,
    mark_parts,
    repeat_counted,
    repeat_parts,
)


class Tables(Protocol):
    """What the marts read from: staging frames and other marts."""

    # Whether the declared keys of the source tables are known to be unique.
    keys_checked: bool

    def stg(self, name: str) -> DataFrame: ...

    def mart(self, name: str) -> DataFrame: ...

    def has(self, name: str) -> bool: ...


def _lookup(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """LEFT JOIN by a column both sides share, keeping the left side's copy."""
    return left.join(right, on=key, how="left")


def _once(tables: Tables, rows: DataFrame) -> DataFrame:
    """Drop repeated rows of a frame that holds its table's declared key.

    Where the key is checked there are none, and the shuffle is saved. Otherwise copies
    collapse within each task before the shuffle, however many a row has.
    """
    return rows if tables.keys_checked else rows.distinct()


# --- dimensions -----------------------------------------------------------------------

def dim_customers(tables: Tables) -> DataFrame:
    """Customers that ordered, with their person and store."""
    ordering = tables.stg("stg_salesorderheader").select(
        F.col("customerid").alias("ordering_customerid")).distinct()
    customers = _once(tables, tables.stg("stg_customer").select(
        "customerid", "personid", "storeid"))
    people = _once(tables, tables.stg("stg_person").select(
        "businessentityid", "firstname", "lastname", "persontype",
        F.concat("firstname", F.lit(" "), "lastname").alias("fullname")))
    stores = _once(tables, tables.stg("stg_store").select(
        F.col("businessentityid").alias("storebusinessid"), "namestore"))

    known = ordering.join(
        customers, F.col("ordering_customerid") == F.col("customerid"), "left")
    # Many customers have no person or no store.
    named = left_join_nullable(known, people, "personid", "businessentityid",
                               spread_by="ordering_customerid")
    stored = left_join_nullable(named, stores, "storeid", "storebusinessid",
                                spread_by="ordering_customerid")
    return stored.select(
        surrogate_key("ordering_customerid").alias("customersk"),
        "customerid",
        F.col("firstname").alias("customerfirstname"),
        F.col("lastname").alias("customerlastname"),
        F.col("fullname").alias("customerfullname"),
        F.col("persontype").alias("customerpersontype"),
        "namestore")


def customer_person_types(tables: Tables) -> DataFrame:
    """``customerfk`` and person type of every customer, whether they ordered or not."""
    customers = _once(tables, tables.stg("stg_customer").select("customerid", "personid"))
    people = _once(tables, tables.stg("stg_person").select(
        "businessentityid", F.col("persontype").alias("customerpersontype")))
    typed = left_join_nullable(customers, people, "personid", "businessentityid",
                               spread_by="customerid")
    return typed.select(surrogate_key("customerid").alias("customerfk"), "customerpersontype")


def product_attributes(tables: Tables) -> DataFrame:
    """Every product with cost, subcategory and category."""
    products = _once(tables, tables.stg("stg_product").select(
        "productid", "product_name", "productsubcategoryid", "standardcost"))
    subcategories = _once(tables, tables.stg("stg_productsubcategory").select(
        "productsubcategoryid", "productcategoryid", "productsubcategory_name"))
    categories = _once(tables, tables.stg("stg_productcategory").select(
        "productcategoryid", "productcategory_name"))
    return (products.transform(_lookup, subcategories, "productsubcategoryid")
            .transform(_lookup, categories, "productcategoryid")
            .select("productid", "product_name", "productsubcategory_name",
                    "productcategory_name", "standardcost"))


def dim_products(tables: Tables) -> DataFrame:
    """Products that sold."""
    sold = (tables.stg("stg_salesorderdetail").where(F.col("productid").isNotNull())
            .select("productid").distinct())
    return _lookup(sold, product_attributes(tables), "productid").select(
        surrogate_key("productid").alias("productsk"), "productid", "product_name",
        "productsubcategory_name", "productcategory_name")


def address_attributes(tables: Tables) -> DataFrame:
    """Every address with its state and country."""
    addresses = _once(tables, tables.stg("stg_address").select(
        "addressid", "city", "stateprovinceid", "postalcode"))
    states = _once(tables, tables.stg("stg_stateprovince").select(
        "stateprovinceid", "stateprovincecode", "stateprovince_name",
        F.col("countryregioncode").alias("statecountrycode")))
    countries = _once(tables, tables.stg("stg_countryregion").select(
        "countryregioncode", "countryregion_name"))
    return (_lookup(addresses, states, "stateprovinceid")
            .join(countries, F.col("statecountrycode") == F.col("countryregioncode"), "left")
            .select("addressid", "city", "postalcode", "stateprovincecode",
                    "stateprovince_name", "countryregioncode", "countryregion_name"))


def _territories(tables: Tables) -> DataFrame:
    return _once(tables, tables.stg("stg_salesterritory").select("territoryid", "territory_name"))


def dim_locations(tables: Tables) -> DataFrame:
    """Billing addresses in use, with the sales territory of their orders.

    An address billed from two territories appears twice; the unique test on ``addressid``
    reports it.
    """
    billed = tables.stg("stg_salesorderheader").select(
        F.col("billtoaddressid").alias("addressid"), "territoryid").distinct()
    return (_lookup(billed, address_attributes(tables), "addressid")
            .transform(_lookup, _territories(tables), "territoryid")
            .select(surrogate_key("addressid").alias("locationsk"), "addressid", "city",
                    "postalcode", "stateprovincecode", "stateprovince_name",
                    "territory_name", "countryregioncode", "countryregion_name"))


def dim_creditcards(tables: Tables) -> DataFrame:
    """Credit cards that paid for an order."""
    used = (tables.stg("stg_salesorderheader").where(F.col("creditcardid").isNotNull())
            .select("creditcardid").distinct())
    cards = tables.stg("stg_creditcard").select("creditcardid", "cardtype")
    return _lookup(used, cards, "creditcardid").select(
        surrogate_key("creditcardid").alias("creditcardsk"), "creditcardid", "cardtype")


def dim_reasons(tables: Tables) -> DataFrame:
    """One row per order with its sales reasons joined in alphabetical order.

    The reasons of an order are collected as a set of ids that the lookup knows, so repeated links
    of one order collapse before the shuffle and a group never holds more entries than the lookup
    has rows. Names are looked up after it, for each id of an order once.
    """
    links = tables.stg("stg_salesorderheadersalesreason").select("salesorderid", "salesreasonid")
    reasons = tables.stg("stg_salesreason").select(
        "salesreasonid", "salesreason_name",
        "reasontype", F.lit(True).alias("known"))
    reason = F.struct("salesreasonid", "salesreason_name", "reasontype")
    ids = (_lookup(links, reasons.select("salesreasonid", "known"), "salesreasonid")
           .groupBy("salesorderid")
           .agg(F.collect_set(F.when(F.col("known"), F.col("salesreasonid"))).alias("ids")))
    per_order = (_lookup(ids.select("salesorderid", F.explode_outer("ids").alias("salesreasonid")),
                         reasons, "salesreasonid")
                 .groupBy("salesorderid")
                 .agg(F.collect_set(F.when(F.col("known"), reason)).alias("reasons")))

    def joined(field: str):
        present = F.filter(F.transform("reasons", lambda r: r[field]), lambda v: v.isNotNull())
        return F.array_join(F.sort_array(present), labels.REASON_SEPARATOR)

    texts = per_order.select("salesorderid", joined("salesreason_name").alias("names"),
                             joined("reasontype").alias("reasontype"))
    flags = [F.when(F.contains(F.col("names"), F.lit(text)), 1).otherwise(0).alias(flag)
             for flag, (text, _) in labels.REASON_FLAGS.items()]
    return texts.select(
        surrogate_key("salesorderid").alias("reasonsk"), "salesorderid", "reasontype",
        translate("names", labels.REASON_LABELS, F.col("names")).alias("salesreason_name"),
        *flags)


def calendar(days: DataFrame) -> DataFrame:
    """Calendar columns for a frame with one ``metric_date`` per row."""
    date = F.col("metric_date")
    return days.select(
        "metric_date",
        F.day(date).alias("metric_day"),
        F.month(date).alias("metric_month"),
        F.year(date).alias("metric_year"),
        F.quarter(date).alias("metric_quarter"),
        F.when(F.quarter(date).isin(1, 2), 1).otherwise(2).alias("semester"),
        translate(F.dayofweek(date), labels.WEEKDAY_NAMES).alias("dayofweek"),
        translate(F.month(date), labels.MONTH_NAMES).alias("fullmonth"))


def dim_dates(tables: Tables, start: str | None = None, end: str | None = None) -> DataFrame:
    """Every day from ``start`` up to, not including, ``end``.

    Without bounds the calendar covers the whole years in which orders were placed.
    """
    ordered = tables.stg("stg_salesorderheader").agg(
        F.trunc(F.min("orderdate"), "YEAR").alias("first"),
        F.add_months(F.trunc(F.max("orderdate"), "YEAR"), 12).alias("end"))
    first = F.lit(start).cast("date") if start else F.col("first")
    last = F.date_sub(F.lit(end).cast("date") if end else F.col("end"), 1)
    return calendar(ordered.select(F.explode(F.sequence(first, last)).alias("metric_date")))


# --- facts ----------------------------------------------------------------------------

HEADER_COLUMNS = (
    "orderdate", "shipdate", "statussales", "onlineorderflag", "subtotal", "taxamt", "freight",
    "totaldue")
LOCATION_COLUMNS = (
    "city", "postalcode", "stateprovince_name", "territory_name", "countryregion_name")
ADDRESS_COLUMNS = ("city", "postalcode", "stateprovince_name", "countryregion_name")
REASON_COLUMNS = ("salesreason_name", "reasontype", *labels.REASON_FLAGS)
ORDER_KEYS = ("customerfk", "locationfk", "creditcardfk", "reasonfk")
ORDER_COLUMNS = (*ORDER_KEYS, *HEADER_COLUMNS, *LOCATION_COLUMNS, *REASON_COLUMNS)

TOTALS_COLUMNS = (*ORDER_COLUMNS, "customerid", "billtoaddressid", "creditcardid")

FACT_COLUMNS = (
    "factsalessk", "salesorderid", *ORDER_KEYS, "productfk", *HEADER_COLUMNS, "orderqty",
    "unitprice", "unitpricediscount", "amountpaidproduct", "standardcost", "listprice",
    *LOCATION_COLUMNS, *REASON_COLUMNS)


# What the keys of an order are hashed from. Joins carry these, which are short; hashes hardly
# compress, so they are made from them when no shuffle follows.
NATURAL_KEYS = ("customerid", "billtoaddressid", "creditcardid")


def order_rows(tables: Tables, columns: tuple[str, ...] = ORDER_COLUMNS) -> DataFrame:
    """One row per order with its lookups, ready for :func:`order_keys`.

    Holds what the wanted order-level fact columns need. Only lookups that a wanted column needs are
    joined. Each is a plain join of two shuffled inputs if the looked-up table is large, so customers
    and addresses with very many orders are split by adaptive execution. The reasons come last: they
    are joined on the same key as the order lines.
    """
    wanted = set(columns)
    natural, plain = _order_columns(wanted)
    rows = _look_up(tables, _once(
        tables, tables.stg("stg_salesorderheader").select("salesorderid", *natural, *plain)),
        wanted)
    return _with_reasons(tables, rows, wanted)


def _order_columns(wanted: set[str]) -> tuple[list[str], list[str]]:
    """The natural keys that wanted columns are made from, and the wanted columns of the header."""
    needed = {
        "customerid": bool(wanted & {"customerfk", "customerid"}),
        "billtoaddressid": bool(wanted & {"locationfk", "billtoaddressid", *ADDRESS_COLUMNS}),
        "creditcardid": bool(wanted & {"creditcardfk", "creditcardid"}),
        "territoryid": "territory_name" in wanted,
    }
    return ([key for key, needs in needed.items() if needs],
            [column for column in HEADER_COLUMNS if column in wanted])


def _look_up(tables: Tables, rows: DataFrame, wanted: set[str]) -> DataFrame:
    """Add what wanted columns need of customers, addresses and territories."""
    if "customerfk" in wanted:
        customers = _once(tables, tables.stg("stg_customer").select(
            "customerid", surrogate_key("customerid").alias("customerfk")))
        rows = _lookup(rows, customers.select(
            "customerid", F.col("customerfk").isNotNull().alias("customer_known")), "customerid")
    if wanted & set(ADDRESS_COLUMNS):
        addresses = address_attributes(tables).withColumnRenamed("addressid", "billtoaddressid")
        rows = _lookup(rows, addresses, "billtoaddressid")
    if "territory_name" in wanted:
        rows = _lookup(rows, _territories(tables), "territoryid")
    return rows


def _with_reasons(tables: Tables, rows: DataFrame, wanted: set[str]) -> DataFrame:
    if wanted & {"reasonfk", *REASON_COLUMNS}:
        reasons = tables.mart("dim_reasons").drop("reasonsk")
        rows = _lookup(rows, reasons.withColumn("reasons_known", F.lit(True)), "salesorderid")
    return rows


LOOKUP_KEYS = ("customerid", "billtoaddressid", "territoryid")


def gathered_order_rows(tables: Tables, columns: tuple[str, ...], hot: DataFrame | None = None
                        ) -> DataFrame:
    """The rows of :func:`order_rows` for many columns, without reasons and orders without an id.

    Each large lookup shuffles what it is joined with, so only the ids of orders go through them.
    What they find meets the headers by order, in one shuffle of both, where repeated headers
    collapse. With ``hot``, orders are repeated as by :func:`repeat_parts` and dealt by part too.
    """
    wanted = set(columns)
    natural, plain = _order_columns(wanted)
    ids = [key for key in natural if key in LOOKUP_KEYS]
    orders = tables.stg("stg_salesorderheader").where(F.col("salesorderid").isNotNull())
    looked_up = _look_up(tables, _once(tables, orders.select("salesorderid", *ids)), wanted)
    found = [name for name in ("customer_known", *LOCATION_COLUMNS)
             if name in wanted or name == "customer_known" and "customerfk" in wanted]
    header = F.struct(*natural, *plain)
    lookups = F.struct(*ids, *found)
    none = F.lit(None)
    rows = orders.select("salesorderid", header.alias("_header"), none.alias("_found")).union(
        looked_up.select("salesorderid", none.alias("_header"), lookups.alias("_found")))
    keys = ["salesorderid"]
    if hot is not None:
        rows = repeat_parts(rows, "salesorderid", hot)
        keys.append("_right_part")
    gather = F.collect_list if tables.keys_checked else F.collect_set
    gathered = rows.repartition(*keys).groupBy(*keys).agg(
        gather("_header").alias("_headers"), F.collect_list("_found").alias("_found"))

    def own(lookup: Column) -> Column:
        matches = [lookup[key].eqNullSafe(F.col("_header")[key]) for key in ids]
        return reduce(Column.__and__, matches, F.lit(True))

    return (gathered.select(*keys, F.explode("_headers").alias("_header"), "_found")
            .select(*keys, "_header", F.explode(F.filter("_found", own)).alias("_found"))
            .select(*keys, "_header.*", *(F.col("_found")[name].alias(name) for name in found)))


def order_keys() -> dict[str, Column]:
    """The keys of an order from the columns of :func:`order_rows`; all are NULL if there is none."""
    return {"customerfk": F.when(F.col("customer_known"), surrogate_key("customerid")),
            "locationfk": foreign_key("billtoaddressid"),
            "creditcardfk": foreign_key("creditcardid"),
            "reasonfk": F.when(F.col("reasons_known"), surrogate_key("salesorderid"))}


def look_up_customers(tables: Tables, rows: DataFrame) -> DataFrame:
    """Add ``customerfk`` to rows with a ``customerid``; NULL for unknown customers."""
    customers = _once(tables, tables.stg("stg_customer").select(
        "customerid", surrogate_key("customerid").alias("customerfk")))
    return _lookup(rows, customers, "customerid")


def line_amount() -> Column:
    """What was paid for a line; the discount is an amount per unit."""
    return F.col("orderqty") * (F.col("unitprice") - F.col("unitpricediscount"))


def line_totals(amount: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("line_count"),
            F.sum("orderqty").alias("quantity"),
            F.sum(amount).alias("amount")]


def order_total_rows(tables: Tables, columns: tuple[str, ...] = ORDER_COLUMNS, *,
                     condition: Column | None = None, split_by: str | None = None) -> DataFrame:
    """The rows of :func:`order_totals` before their keys are made."""
    lines = tables.stg("stg_salesorderdetail")
    split = [split_by] if split_by else []
    if split_by:
        lines = _lookup(lines, product_attributes(tables).select("productid", split_by),
                        "productid")
    totals = (lines.groupBy(F.col("salesorderid").alias("line_salesorderid"), *split)
              .agg(*line_totals(line_amount())))
    if set(ORDER_COLUMNS) <= set(columns):
        orders = _with_reasons(tables, gathered_order_rows(tables, columns), set(columns))
    else:
        orders = order_rows(tables, columns)
    if condition is not None:
        orders = orders.where(condition)
    return totals.join(orders, F.col("line_salesorderid") == F.col("salesorderid"),
                       "left" if condition is None else "inner")


def keyed_totals(rows: DataFrame, columns: tuple[str, ...] = ORDER_COLUMNS,
                 *others: str) -> DataFrame:
    """The columns of :func:`order_totals` from its rows, and ``others``."""
    keys = {name: key for name, key in order_keys().items() if name in columns}
    return rows.withColumns(keys).select(
        "line_salesorderid", "salesorderid", *columns, *others, "line_count", "quantity", "amount")


def order_totals(tables: Tables, columns: tuple[str, ...] = ORDER_COLUMNS, *,
                 condition: Column | None = None, split_by: str | None = None) -> DataFrame:
    """One row per order that has lines: order columns, line count, quantity and amount.

    The lines are totalled first, so an order with very many lines is one row per task ahead
    of the shuffle. ``line_salesorderid`` is the id on the lines; ``salesorderid`` is NULL if
    there is no such order. ``condition`` keeps matching orders only; ``split_by`` makes a row
    per order and value of a product attribute.
    """
    rows = order_total_rows(tables, columns, condition=condition, split_by=split_by)
    return keyed_totals(rows, columns, *([split_by] if split_by else []))


def fact_rows(tables: Tables, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """The rows of :func:`fact_sales` before keys and amounts, which no shuffle has to carry."""
    lines = tables.stg("stg_salesorderdetail").select(
        F.col("salesorderid").alias("line_salesorderid"), "salesorderdetailid", "orderqty",
        "productid", "unitprice", "unitpricediscount",
        # Numbered at the scan, where a retried task numbers its rows the same way. Unlike the
        # line's own columns it tells apart even equal lines of one order.
        F.monotonically_increasing_id().alias("scan_number"))
    prices = _once(tables, tables.stg("stg_product").select(
        "productid", "standardcost", "listprice"))
    reasons = None
    if tables.has("order_totals"):
        totals = tables.mart("order_totals")
        orders = totals.where(F.col("salesorderid").isNotNull()).withColumns({
            "customer_known": F.col("customerfk").isNotNull(),
            "reasons_known": F.col("reasonfk").isNotNull()})
        orders = orders.select("salesorderid", *NATURAL_KEYS, "customer_known",
                               "reasons_known", *HEADER_COLUMNS, *LOCATION_COLUMNS, *REASON_COLUMNS)
        counts = totals.select(F.col("line_salesorderid").alias("key"),
                               F.col("line_count").alias("rows"))
    else:
        # NULL ids are left out here, so that one shuffle serves both uses.
        counts = key_counts(tables.stg("stg_salesorderdetail").where(
            F.col("salesorderid").isNotNull()), "salesorderid")
        reasons = repeat_counted(
            tables.mart("dim_reasons").withColumns({"reasons_known": F.lit(True)}).select(
                F.col("salesorderid").alias("reasons_of"), "reasons_known", *REASON_COLUMNS),
            "reasons_of", counts, rows_per_split)
    hot = hot_keys(counts, rows_per_split)
    if reasons is None:
        orders = repeat_parts(orders, "salesorderid", hot)
    else:
        orders = gathered_order_rows(
            tables, (*ORDER_KEYS[:3], *HEADER_COLUMNS, *LOCATION_COLUMNS), hot).select(
                "salesorderid", "_right_part", *NATURAL_KEYS, "customer_known", *HEADER_COLUMNS,
                *LOCATION_COLUMNS)
    marked = mark_parts(lines, "line_salesorderid", "scan_number", hot).drop("scan_number")
    rows = left_join_parts(_lookup(marked, prices, "productid"), orders,
                           "line_salesorderid", "salesorderid")
    if reasons is not None:
        # By the line's id, by which the lines are dealt; only an order that exists has reasons.
        rows = left_join_parts(rows, reasons, "line_salesorderid", "reasons_of").withColumns({
            name: F.when(F.col("salesorderid").isNotNull(), F.col(name))
            for name in ("reasons_known", *REASON_COLUMNS)}).drop("reasons_of")
    return rows.drop("_part")


def keyed_fact(rows: DataFrame, *others: str, line_key: bool = False) -> DataFrame:
    """The columns of :func:`fact_sales` from its rows, and ``others``."""
    keyed = rows.withColumns(order_keys() | {
        "productfk": foreign_key("productid"), "amountpaidproduct": line_amount()})
    parts = ["salesorderid", *ORDER_KEYS, "orderdate", "productfk"]
    columns = [surrogate_key(*parts).alias("factsalessk"), *FACT_COLUMNS[1:]]
    if line_key:
        columns.append(surrogate_key(*parts, "salesorderdetailid").alias("fact_line_sk"))
    return keyed.select(*columns, *others)


def fact_sales(tables: Tables, line_key: bool = False,
               rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """One row per order line with its order's attributes, 35 columns.

    Lines without a header are kept, with NULL order columns. ``factsalessk`` does not
    include the line id, so two lines of one order with the same product share it;
    ``line_key=True`` adds ``fact_line_sk``, which does. Order attributes and line counts are
    taken from ``order_totals`` if it is built.
    """
    return keyed_fact(fact_rows(tables, rows_per_split), line_key=line_key)


def product_totals(tables: Tables) -> DataFrame:
    """One row per product and order state: quantity, amount and cost of the lines."""
    totals = (tables.mart("fact_sales")
              .groupBy(packed("productfk").alias("_packed"), "statussales")
              .agg(F.sum("orderqty").alias("quantity"),
                   F.sum("amountpaidproduct").alias("amount"),
                   F.sum(F.col("orderqty") * F.col("standardcost")).alias("cost")))
    return totals.select(unpacked("_packed").alias("productfk"), "statussales", "quantity",
                         "amount", "cost")


def fact_aggsalessellersregion(tables: Tables) -> DataFrame:
    """Orders with a salesperson, counted by country, job title and gender.

    Counted per salesperson and territory first, so the lookups run on that small result.
    """
    sold = (tables.stg("stg_salesorderheader").where(F.col("salespersonid").isNotNull())
            .select("salesorderid", "salespersonid", "territoryid"))
    counted = (_once(tables, sold).groupBy("salespersonid", "territoryid")
               .agg(F.count("salesorderid").alias("orders")))
    employees = _once(tables, tables.stg("stg_employee").select(
        "businessentityid", "jobtitle", "gender"))
    sellers = (_once(tables, tables.stg("stg_salesperson").select("businessentityid"))
               .join(employees, "businessentityid", "left")
               .withColumnRenamed("businessentityid", "salespersonid"))
    countries = _once(tables, tables.stg("stg_countryregion").select(
        "countryregioncode", "countryregion_name"))
    territories = (_once(tables, tables.stg("stg_salesterritory").select(
        "territoryid", "countryregioncode")).transform(_lookup, countries, "countryregioncode"))
    groups = ["countryregion_name", "jobtitle", "gender"]
    totals = (counted.transform(_lookup, sellers, "salespersonid")
              .transform(_lookup, territories, "territoryid")
              .groupBy(*groups).agg(F.sum("orders").alias("totalsalesorders")))
    return totals.select(surrogate_key(*groups).alias("agg_salesregionpersonsk"), *groups,
                         "totalsalesorders")


BITMAP_COLUMNS = ("sales_month", "countryregion_name", "onlineorderflag", "is_sale")


def customer_bitmaps(tables: Tables) -> DataFrame:
    """The known customers of the orders with lines, a bitmap per BITMAP_COLUMNS and block of ids.

    Ids are made distinct, then gathered by block, before any bitmap is made: a task holds the
    bitmaps of its own blocks, of 4 KB each, and a block has at most 32,768 ids per group.
    """
    columns = ("orderdate", "countryregion_name", "onlineorderflag", "statussales")
    if tables.has("order_totals"):
        orders = tables.mart("order_totals").where("salesorderid IS NOT NULL")
    else:
        orders = order_totals(tables, ("customerid", "customerfk", *columns))
    bought = orders.where("customerfk IS NOT NULL").select(
        *(["customerid"] if "customerid" in orders.columns else ["customerfk"]),
        month_start("orderdate").alias("sales_month"), "countryregion_name", "onlineorderflag",
        F.coalesce(~F.col("statussales").isin(*labels.CLOSED_STATUSES), F.lit(False))
        .alias("is_sale")).distinct()
    if "customerid" not in bought.columns:
        bought = bought.join(tables.stg("stg_customer").select(
            "customerid", surrogate_key("customerid").alias("customerfk")), "customerfk")
    ids = bought.select(*BITMAP_COLUMNS, F.bitmap_bucket_number("customerid").alias("block"),
                        F.bitmap_bit_position("customerid").alias("bit"))
    return (ids.repartition(*BITMAP_COLUMNS, "block").groupBy(*BITMAP_COLUMNS, "block")
            .agg(F.bitmap_construct_agg("bit").alias("bitmap")))


MARTS: dict[str, Callable[[Tables], DataFrame]] = {
    "dim_customers": dim_customers,
    "dim_products": dim_products,
    "dim_locations": dim_locations,
    "dim_creditcards": dim_creditcards,
    "dim_reasons": dim_reasons,
    "dim_dates": dim_dates,
    "fact_sales": fact_sales,
    "fact_aggsalessellersregion": fact_aggsalessellersregion,
}

# Written next to the marts, for the reports; the fact takes its order columns from the first.
ROLLUPS: dict[str, Callable[[Tables], DataFrame]] = {
    "order_totals": lambda tables: order_totals(tables, TOTALS_COLUMNS),
    "product_totals": product_totals,
    "customer_bitmaps": customer_bitmaps,
}
