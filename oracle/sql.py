"""SQL that computes each registered query from the raw tables, without Spark.

Written at line grain and without the library's rewrites (pre-aggregation, computed foreign
keys, pruned lookups), so that agreement says something about them. Only the adapter
expressions and the fixed label tables are shared with the library.
"""

from __future__ import annotations

import re

from tradewind.functions import labels
from tradewind.operators.features import FEATURES, LAGS, ROLLING, TIME_FEATURES
from tradewind.plans.checks import MART_CHECKS, SOURCE_CHECKS
from tradewind.plans.staging import STAGING
from tradewind.sources.feed import FEED


def _text(value) -> str:
    return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"


def _case(expression: str, table: dict, otherwise: str = "NULL") -> str:
    branches = " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in table.items())
    return f"CASE {expression} {branches} ELSE {otherwise} END"


def _key(*parts: str) -> str:
    texts = f" || '{labels.KEY_SEPARATOR}' || ".join(
        f"coalesce(CAST({part} AS VARCHAR), '{labels.KEY_NULL}')" for part in parts)
    return f"md5({texts})"


def _money(expression: str) -> str:
    return f"CAST(round({expression}, 2) AS DECIMAL(38,2))"


VIEWS: dict[str, str] = {}

for (_schema, _table), _mapping in FEED.items():
    VIEWS[f"src_{_table}"] = (
        "SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in _mapping.columns.items())
        + f" FROM {_mapping.feed}")

# Staging: REPLACE keeps the column order of the source and swaps single expressions.
_DAY = "CAST(modifieddate AS DATE) AS modifieddate"


def _staged(table: str, *replaced: str) -> str:
    return f"SELECT * REPLACE ({', '.join((_DAY, *replaced))}) FROM src_{table}"


VIEWS |= {
    "stg_address": _staged("address"),
    "stg_countryregion": "SELECT countryregioncode, "
        f"{_case('name', labels.COUNTRY_LABELS)} AS countryregion_name, {_DAY} "
        "FROM src_countryregion",
    "stg_creditcard": _staged("creditcard"),
    "stg_customer": _staged("customer"),
    "stg_employee": "SELECT * REPLACE ("
        f"{_case('jobtitle', labels.JOB_TITLE_LABELS)} AS jobtitle), "
        "CAST(modifieddate AS DATE) AS modified_date FROM src_employee",
    "stg_person": _staged("person", _case(
        "persontype", labels.PERSON_TYPE_LABELS, _text(labels.UNKNOWN_PERSON_TYPE))
        + " AS persontype"),
    "stg_product": "SELECT name AS product_name, * EXCLUDE (name) REPLACE "
        f"({_DAY}, CAST(sellstartdate AS DATE) AS sellstartdate, "
        "CAST(sellenddate AS DATE) AS sellenddate) FROM src_product",
    "stg_productcategory": "SELECT productcategoryid, "
        f"{_case('name', labels.CATEGORY_LABELS)} AS productcategory_name, rowguid, {_DAY} "
        "FROM src_productcategory",
    "stg_productsubcategory": "SELECT productsubcategoryid, productcategoryid, "
        f"{_case('name', labels.SUBCATEGORY_LABELS, _text(labels.OTHER_SUBCATEGORY))} "
        f"AS productsubcategory_name, rowguid, {_DAY} FROM src_productsubcategory",
    "stg_salesorderdetail": _staged("salesorderdetail"),
    "stg_salesorderheader": "SELECT "
        f"{_case('status', labels.STATUS_LABELS)} AS statussales, * EXCLUDE (status) REPLACE "
        f"({_DAY}, CAST(orderdate AS DATE) AS orderdate, CAST(duedate AS DATE) AS duedate, "
        "CAST(shipdate AS DATE) AS shipdate) FROM src_salesorderheader",
    "stg_salesorderheadersalesreason": _staged("salesorderheadersalesreason"),
    "stg_salesperson": _staged("salesperson"),
    "stg_salesreason": "SELECT salesreasonid, name AS salesreason_name, reasontype, "
        f"{_DAY} FROM src_salesreason",
    "stg_salesterritory": "SELECT territoryid, "
        f"{_case('name', labels.TERRITORY_LABELS)} AS territory_name, countryregioncode, "
        f'"group" AS territorygroup, rowguid, {_DAY} FROM src_salesterritory',
    "stg_stateprovince": "SELECT name AS stateprovince_name, * EXCLUDE (name) REPLACE "
        f"({_DAY}) FROM src_stateprovince",
    "stg_store": "SELECT name AS namestore, * EXCLUDE (name) REPLACE "
        f"({_DAY}) FROM src_store",
}

_FLAGS = ", ".join(
    f"CAST(contains(names, {_text(text)}) AS INT) AS {flag}"
    for flag, (text, _) in labels.REASON_FLAGS.items())
_LOCATION = "city, postalcode, stateprovince_name, territory_name, countryregion_name"
_REASON = ", ".join(["salesreason_name", "reasontype", *labels.REASON_FLAGS])

VIEWS |= {
    "dim_customers": f"""
        SELECT {_key('o.customerid')} AS customersk, c.customerid,
               p.firstname AS customerfirstname, p.lastname AS customerlastname,
               p.firstname || ' ' || p.lastname AS customerfullname,
               p.persontype AS customerpersontype, s.namestore
        FROM (SELECT DISTINCT customerid FROM stg_salesorderheader) o
        LEFT JOIN stg_customer c USING (customerid)
        LEFT JOIN stg_person p ON p.businessentityid = c.personid
        LEFT JOIN stg_store s ON s.businessentityid = c.storeid""",
    "dim_products": f"""
        SELECT {_key('d.productid')} AS productsk, d.productid, p.product_name,
               sc.productsubcategory_name, pc.productcategory_name
        FROM (SELECT DISTINCT productid FROM stg_salesorderdetail
              WHERE productid IS NOT NULL) d
        LEFT JOIN stg_product p USING (productid)
        LEFT JOIN stg_productsubcategory sc USING (productsubcategoryid)
        LEFT JOIN stg_productcategory pc USING (productcategoryid)""",
    "dim_locations": f"""
        SELECT {_key('h.billtoaddressid')} AS locationsk, h.billtoaddressid AS addressid,
               a.city, a.postalcode, st.stateprovincecode, st.stateprovince_name,
               t.territory_name, cr.countryregioncode, cr.countryregion_name
        FROM (SELECT DISTINCT billtoaddressid, territoryid FROM stg_salesorderheader) h
        LEFT JOIN stg_address a ON a.addressid = h.billtoaddressid
        LEFT JOIN stg_stateprovince st ON st.stateprovinceid = a.stateprovinceid
        LEFT JOIN stg_salesterritory t ON t.territoryid = h.territoryid
        LEFT JOIN stg_countryregion cr ON cr.countryregioncode = st.countryregioncode""",
    "dim_creditcards": f"""
        SELECT {_key('h.creditcardid')} AS creditcardsk, h.creditcardid, cc.cardtype
        FROM (SELECT DISTINCT creditcardid FROM stg_salesorderheader
              WHERE creditcardid IS NOT NULL) h
        LEFT JOIN stg_creditcard cc USING (creditcardid)""",
    "order_reasons": f"""
        SELECT b.salesorderid,
               coalesce(string_agg(r.salesreason_name, ' | ' ORDER BY r.salesreason_name), '')
                   AS names,
               coalesce(string_agg(r.reasontype, ' | ' ORDER BY r.reasontype), '') AS reasontype
        FROM (SELECT DISTINCT salesorderid, salesreasonid
              FROM stg_salesorderheadersalesreason) b
        LEFT JOIN stg_salesreason r USING (salesreasonid) GROUP BY b.salesorderid""",
    "dim_reasons": f"""
        SELECT {_key('salesorderid')} AS reasonsk, salesorderid, reasontype,
               {_case('names', labels.REASON_LABELS, 'names')} AS salesreason_name, {_FLAGS}
        FROM order_reasons""",
    "dim_dates": f"""
        SELECT metric_date, CAST(day(metric_date) AS INT) AS metric_day,
               CAST(month(metric_date) AS INT) AS metric_month,
               CAST(year(metric_date) AS INT) AS metric_year,
               CAST(quarter(metric_date) AS INT) AS metric_quarter,
               CAST(ceil(quarter(metric_date) / 2.0) AS INT) AS semester,
               {_case('dayofweek(metric_date) + 1', labels.WEEKDAY_NAMES)} AS dayofweek,
               {_case('month(metric_date)', labels.MONTH_NAMES)} AS fullmonth
        FROM (SELECT CAST(unnest(generate_series(
                  date_trunc('year', min(orderdate)),
                  date_trunc('year', max(orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                  INTERVAL 1 DAY)) AS DATE) AS metric_date
              FROM stg_salesorderheader)""",
    "fact_sales": f"""
        SELECT {_key('h.salesorderid', 'customersk', 'locationsk', 'creditcardsk', 'reasonsk',
                     'h.orderdate', 'productsk')} AS factsalessk,
               h.salesorderid, customersk AS customerfk, locationsk AS locationfk,
               creditcardsk AS creditcardfk, reasonsk AS reasonfk, productsk AS productfk,
               h.orderdate, h.shipdate, h.statussales, h.onlineorderflag, h.subtotal, h.taxamt,
               h.freight, h.totaldue, d.orderqty, d.unitprice, d.unitpricediscount,
               CAST(d.orderqty * (d.unitprice - d.unitpricediscount) AS DECIMAL(31,4))
                   AS amountpaidproduct,
               p.standardcost, p.listprice, {_LOCATION}, {_REASON}
        FROM stg_salesorderdetail d
        LEFT JOIN dim_products dp ON dp.productid = d.productid
        LEFT JOIN stg_product p ON p.productid = d.productid
        LEFT JOIN (SELECT DISTINCT * FROM stg_salesorderheader) h
               ON h.salesorderid = d.salesorderid
        LEFT JOIN dim_customers dc ON dc.customerid = h.customerid
        LEFT JOIN dim_locations dl ON dl.addressid = h.billtoaddressid
        LEFT JOIN dim_creditcards dcc ON dcc.creditcardid = h.creditcardid
        LEFT JOIN dim_reasons dr ON dr.salesorderid = h.salesorderid""",
    "fact_aggsalessellersregion": f"""
        SELECT {_key('countryregion_name', 'jobtitle', 'gender')} AS agg_salesregionpersonsk,
               countryregion_name, jobtitle, gender,
               CAST(count(salesorderid) AS BIGINT) AS totalsalesorders
        FROM (SELECT DISTINCT salesorderid, salespersonid, territoryid
              FROM stg_salesorderheader WHERE salespersonid IS NOT NULL) h
        LEFT JOIN stg_salesperson sp ON sp.businessentityid = h.salespersonid
        LEFT JOIN stg_employee e ON e.businessentityid = sp.businessentityid
        LEFT JOIN stg_salesterritory t ON t.territoryid = h.territoryid
        LEFT JOIN stg_countryregion cr ON cr.countryregioncode = t.countryregioncode
        GROUP BY countryregion_name, jobtitle, gender""",
    "sales_lines": "SELECT * FROM fact_sales WHERE statussales NOT IN ("
        + ", ".join(_text(status) for status in labels.CLOSED_STATUSES) + ")",
    "sales_orders": "SELECT DISTINCT salesorderid, customerfk, orderdate, onlineorderflag, "
        "totaldue, countryregion_name FROM sales_lines",
}

_MONTH = "CAST(date_trunc('month', orderdate) AS DATE)"
_ORDERS = "count(DISTINCT salesorderid)"
_CHANNEL = (f"CASE WHEN onlineorderflag THEN {_text(labels.ONLINE_CHANNEL)} "
            f"ELSE {_text(labels.STORE_CHANNEL)} END")
_CHANNEL_ROWS = (f"SELECT {_CHANNEL} AS channel, {_ORDERS} AS total_orders, "
                 f"{_money('sum(totaldue)')} AS total_revenue FROM %s GROUP BY channel")
_COUNTRY_ROWS = (f"SELECT countryregion_name AS country, {_money('sum(totaldue)')} AS "
                 f"total_revenue, {_ORDERS} AS total_orders FROM %s "
                 "WHERE countryregion_name IS NOT NULL GROUP BY country")
_MONTH_ROWS = (f"SELECT {_MONTH} AS order_month, {_money('sum(totaldue)')} AS monthly_revenue, "
               f"{_ORDERS} AS monthly_orders FROM %s GROUP BY order_month")
_REASON_ROWS = " UNION ALL ".join(
    f"SELECT {_text(label)} AS reason, CAST(sum({flag}) AS BIGINT) AS occurrences "
    "FROM sales_lines" for flag, (_, label) in labels.REASON_FLAGS.items())
_STATUS_ROWS = (f"SELECT statussales AS status, {_ORDERS} AS total_orders, "
                f"{_money('sum(totaldue)')} AS total_revenue FROM fact_sales GROUP BY status")


def _shares(rows: str, value: str, columns: str) -> str:
    return (f"SELECT {columns}, {_money(f'100.0 * {value} / sum({value}) OVER ()')} AS share_pct "
            f"FROM ({rows})")


_SELLERS = ("SELECT countryregion_name AS country, gender, jobtitle, "
            "CAST(sum(totalsalesorders) AS BIGINT) AS total_orders "
            "FROM fact_aggsalessellersregion GROUP BY ALL")

REPORTS: dict[str, str] = {
    "kpi_general": f"""
        SELECT {_ORDERS} AS total_orders, count(DISTINCT customerfk) AS total_customers,
               {_money('sum(totaldue)')} AS total_revenue,
               {_money('avg(totaldue)')} AS avg_order_value,
               {_money('sum(amountpaidproduct)')} AS total_product_revenue,
               CAST(sum(orderqty) AS BIGINT) AS total_items_sold
        FROM sales_lines""",
    "kpi_order_grain": f"""
        SELECT o.*, l.total_product_revenue, l.total_items_sold
        FROM (SELECT count(*) AS total_orders, count(DISTINCT customerfk) AS total_customers,
                     {_money('sum(totaldue)')} AS total_revenue,
                     {_money('avg(totaldue)')} AS avg_order_value FROM sales_orders) o,
             (SELECT {_money('sum(amountpaidproduct)')} AS total_product_revenue,
                     CAST(sum(orderqty) AS BIGINT) AS total_items_sold FROM sales_lines) l""",
    "monthly_revenue": _MONTH_ROWS % "sales_lines",
    "monthly_order_grain": _MONTH_ROWS % "sales_orders",
    "quarterly_revenue": f"""
        SELECT CAST(year(orderdate) AS INT) AS year, CAST(quarter(orderdate) AS INT) AS quarter,
               'Q' || quarter(orderdate) || ' ' || year(orderdate) AS period,
               {_money('sum(totaldue)')} AS quarterly_revenue
        FROM sales_lines GROUP BY ALL""",
    "calendar_revenue": f"""
        SELECT m.order_month, coalesce(r.monthly_revenue, CAST(0 AS DECIMAL(38,2)))
                   AS monthly_revenue, coalesce(r.monthly_orders, 0) AS monthly_orders
        FROM (SELECT DISTINCT CAST(date_trunc('month', metric_date) AS DATE) AS order_month
              FROM dim_dates) m
        LEFT JOIN ({_MONTH_ROWS % 'sales_lines'}) r USING (order_month)""",
    "top_products": f"""
        SELECT product_name, productsubcategory_name AS subcategory,
               productcategory_name AS category,
               {_money('sum(amountpaidproduct)')} AS total_revenue,
               CAST(sum(orderqty) AS BIGINT) AS total_qty
        FROM sales_lines JOIN dim_products ON productfk = productsk
        GROUP BY ALL
        ORDER BY total_revenue DESC NULLS FIRST, product_name NULLS FIRST,
                 subcategory NULLS FIRST, category NULLS FIRST LIMIT 10""",
    "revenue_by_category": f"""
        SELECT productcategory_name AS category,
               {_money('sum(amountpaidproduct)')} AS total_revenue,
               {_money('sum(orderqty * standardcost)')} AS total_cost,
               {_money('sum(amountpaidproduct) - sum(orderqty * standardcost)')}
                   AS gross_profit
        FROM sales_lines JOIN dim_products ON productfk = productsk
        WHERE productcategory_name IS NOT NULL GROUP BY category""",
    "revenue_by_country": _COUNTRY_ROWS % "sales_lines",
    "country_order_grain": _COUNTRY_ROWS % "sales_orders",
    "sales_channel": _CHANNEL_ROWS % "sales_lines",
    "channel_order_grain": _CHANNEL_ROWS % "sales_orders",
    "order_status": _STATUS_ROWS,
    "sales_reasons": "SELECT " + ", ".join(
        f"CAST(sum({flag}) AS BIGINT) AS {flag}_count" for flag in labels.REASON_FLAGS)
        + " FROM sales_lines",
    "reasons_long": _REASON_ROWS,
    "sellers_by_region": _SELLERS,
    "sellers_country_gender": "SELECT country, gender, CAST(sum(total_orders) AS BIGINT) "
        f"AS total_orders FROM ({_SELLERS}) GROUP BY ALL",
    "online_share": f"""
        SELECT count(DISTINCT salesorderid) FILTER (WHERE onlineorderflag) AS online_orders,
               {_ORDERS} AS total_orders,
               {_money('100.0 * online_orders / total_orders')} AS online_pct
        FROM sales_lines""",
    "countries_served":
        "SELECT count(DISTINCT countryregion_name) AS countries FROM sales_lines",
    "channel_share": _shares(_CHANNEL_ROWS % "sales_lines", "total_revenue",
                             "channel, total_revenue"),
    "reason_share": _shares(_REASON_ROWS, "occurrences", "reason, occurrences"),
    "status_share": _shares(_STATUS_ROWS, "total_orders", "status, total_orders"),
    "customer_profile": f"""
        SELECT customerpersontype, {_ORDERS} AS total_orders,
               count(DISTINCT customerfk) AS total_customers,
               {_money('sum(totaldue)')} AS total_revenue
        FROM sales_lines JOIN dim_customers ON customerfk = customersk
        GROUP BY customerpersontype""",
}


_CUSTOMERS = "count(DISTINCT customerfk) AS customers"
_KNOWN = "WHERE customerfk IS NOT NULL GROUP BY ALL"

CUSTOMERS = {
    "customers_total": f"SELECT {_CUSTOMERS} FROM sales_lines",
    "customers_by_month": f"SELECT {_MONTH} AS order_month, {_CUSTOMERS} FROM fact_sales {_KNOWN}",
    "customers_by_country":
        f"SELECT countryregion_name AS country, {_CUSTOMERS} FROM sales_lines {_KNOWN}",
    "customers_by_channel": f"SELECT {_CHANNEL} AS channel, {_CUSTOMERS} FROM sales_lines {_KNOWN}",
    "customers_by_quarter_and_country": f"""
        SELECT CAST(year(orderdate) AS INT) AS year, CAST(quarter(orderdate) AS INT) AS quarter,
               countryregion_name AS country, {_CUSTOMERS}
        FROM sales_lines {_KNOWN}""",
}


# --- forecast inputs ------------------------------------------------------------------

def _monthly(series: str, joins: str = "") -> str:
    return f"""
        SELECT {series} AS series_key, {_MONTH} AS order_month, {_ORDERS} AS total_orders,
               sum(totaldue) AS total_revenue, CAST(sum(orderqty) AS BIGINT) AS total_qty,
               count(DISTINCT customerfk) AS unique_customers,
               CAST(sum(totaldue) AS DOUBLE) / count(totaldue) AS avg_order_value
        FROM fact_sales JOIN dim_dates ON orderdate = metric_date {joins}
        GROUP BY ALL"""


_BY_CATEGORY = "LEFT JOIN dim_products ON productfk = productsk"

VIEWS |= {
    "monthly_all": _monthly("'all'"),
}


def _dated(source: str, digits: int = 6) -> str:
    return f"""
        SELECT *, CAST(month(order_month) AS INT) AS month,
               CAST(quarter(order_month) AS INT) AS quarter,
               CAST(year(order_month) AS INT) AS year,
               round(sin(2 * pi() * month(order_month) / 12), {digits}) + 0.0 AS month_sin,
               round(cos(2 * pi() * month(order_month) / 12), {digits}) + 0.0 AS month_cos,
               round(sin(2 * pi() * quarter(order_month) / 4), {digits}) + 0.0 AS quarter_sin,
               round(cos(2 * pi() * quarter(order_month) / 4), {digits}) + 0.0 AS quarter_cos
        FROM {source}"""


def _lagged(source: str, digits: int | None = 4) -> str:
    lags = ", ".join(f"lag(revenue, {lag}) OVER o AS lag_{lag}" for lag in LAGS)
    rounded = "{}" if digits is None else f"round({{}}, {digits})"
    rolling = ", ".join(
        f"CASE WHEN count(revenue) OVER w{size} = {size} THEN "
        f"{rounded.format(f'{function}(revenue) OVER w{size}')} END AS rolling_{size}_{name}"
        for size in ROLLING for name, function in (("mean", "avg"), ("std", "stddev_samp")))
    windows = ", ".join(
        f"w{size} AS (PARTITION BY series_key ORDER BY order_month "
        f"ROWS BETWEEN {size} PRECEDING AND 1 PRECEDING)" for size in ROLLING)
    return f"""
        SELECT * EXCLUDE (revenue), {lags}, {rolling},
               CAST(row_number() OVER o - 1 AS INT) AS trend
        FROM (SELECT *, CAST(total_revenue AS DOUBLE) AS revenue FROM {source})
        WINDOW o AS (PARTITION BY series_key ORDER BY order_month), {windows}"""


VIEWS |= {
    "dated_all": _dated("monthly_all"),
    "lagged_all": _lagged("dated_all"),
    "complete_rows": "SELECT series_key, order_month, CAST(total_revenue AS DOUBLE) AS "
        f"total_revenue, {', '.join(FEATURES)} FROM lagged_all "
        "WHERE lag_12 IS NOT NULL",
    "split_rows": """
        SELECT *, row_number() OVER (ORDER BY order_month) - 1 AS place,
               count(*) OVER () AS total, place < floor(total * 0.8) AS is_train
        FROM complete_rows""",
}

# The same per country and per category, each series on its own.
PANELS = {"by_country": ("countryregion_name", ""),
          "by_category": ("productcategory_name", _BY_CATEGORY)}

for _suffix, (_series, _joins) in PANELS.items():
    VIEWS |= {
        f"monthly_{_suffix}": _monthly(_series, _joins),
        f"dated_{_suffix}": _dated(f"monthly_{_suffix}"),
        f"lagged_{_suffix}": _lagged(f"dated_{_suffix}"),
        f"complete_{_suffix}":
            "SELECT series_key, order_month, CAST(total_revenue AS DOUBLE) AS total_revenue, "
            f"{', '.join(FEATURES)} FROM lagged_{_suffix} WHERE lag_12 IS NOT NULL",
        f"split_{_suffix}": f"""
            SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY order_month) - 1
                       AS place,
                   count(*) OVER (PARTITION BY series_key) AS total,
                   place < floor(total * 0.8) AS is_train
            FROM complete_{_suffix}""",
    }

_VALID = "place BETWEEN n - (5 - fold) * (n // 6) AND n - (5 - fold) * (n // 6) + n // 6 - 1"
_PLAIN_MONTHLY = f"SELECT * REPLACE ({_money('total_revenue')} AS total_revenue) FROM (%s)"

FORECAST: dict[str, str] = {
    "monthly_sales": _PLAIN_MONTHLY % "SELECT * FROM monthly_all",
    "monthly_sales_by_country": _PLAIN_MONTHLY % _monthly("countryregion_name"),
    "monthly_sales_by_category": _PLAIN_MONTHLY % _monthly(
        "productcategory_name", _BY_CATEGORY),
    "time_features": "SELECT series_key, order_month, month, quarter, year, month_sin, "
        f"month_cos, quarter_sin, quarter_cos FROM ({_dated('monthly_all')})",
    "lag_features": f"SELECT series_key, order_month, {_money('total_revenue')} AS "
        f"total_revenue, {', '.join(f for f in FEATURES if f not in TIME_FEATURES)} "
        f"FROM ({_lagged('monthly_all')})",
    "feature_set": "SELECT * REPLACE (round(total_revenue, 4) AS total_revenue) "
        "FROM complete_rows",
    "holdout_split": "SELECT series_key, order_month, is_train FROM split_rows",
    "walk_forward_folds": f"""
        SELECT series_key, CAST(fold AS INT) AS fold,
               count(*) FILTER (WHERE place < n - (5 - fold) * (n // 6)) AS train_rows,
               count(*) FILTER (WHERE {_VALID}) AS valid_rows,
               min(order_month) FILTER (WHERE {_VALID}) AS valid_from,
               max(order_month) FILTER (WHERE {_VALID}) AS valid_to
        FROM (SELECT series_key, order_month, place, count(*) OVER () AS n
              FROM split_rows WHERE is_train), range(5) f(fold)
        GROUP BY ALL""",
    "holdout_metrics_lag1": """
        SELECT round(avg(abs(total_revenue - lag_1)), 4) AS mae,
               round(sqrt(avg((total_revenue - lag_1) ** 2)), 4) AS rmse,
               round(avg(abs((total_revenue - lag_1) / total_revenue))
                     FILTER (WHERE total_revenue <> 0) * 100, 6) AS mape,
               round(1 - sum((total_revenue - lag_1) ** 2)
                     / sum((total_revenue - mean) ** 2), 6) AS r2
        FROM (SELECT *, avg(total_revenue) OVER () AS mean FROM split_rows
              WHERE NOT is_train)""",
}


for _suffix in PANELS:
    FORECAST |= {
        f"feature_set_{_suffix}": "SELECT * REPLACE (round(total_revenue, 4) AS total_revenue) "
            f"FROM complete_{_suffix}",
        f"holdout_split_{_suffix}":
            f"SELECT series_key, order_month, is_train FROM split_{_suffix}",
        f"walk_forward_folds_{_suffix}": f"""
            SELECT series_key, CAST(fold AS INT) AS fold,
                   count(*) FILTER (WHERE place < n - (5 - fold) * (n // 6)) AS train_rows,
                   count(*) FILTER (WHERE {_VALID}) AS valid_rows,
                   min(order_month) FILTER (WHERE {_VALID}) AS valid_from,
                   max(order_month) FILTER (WHERE {_VALID}) AS valid_to
            FROM (SELECT series_key, order_month, place,
                         count(*) OVER (PARTITION BY series_key) AS n
                  FROM split_{_suffix} WHERE is_train), range(5) f(fold)
            GROUP BY ALL""",
        f"holdout_metrics_lag1_{_suffix}": f"""
            SELECT series_key, round(avg(abs(total_revenue - lag_1)), 4) AS mae,
                   round(sqrt(avg((total_revenue - lag_1) ** 2)), 4) AS rmse,
                   round(avg(abs((total_revenue - lag_1) / total_revenue))
                         FILTER (WHERE total_revenue <> 0) * 100, 6) AS mape,
                   round(1 - sum((total_revenue - lag_1) ** 2)
                         / sum((total_revenue - mean) ** 2), 6) AS r2
            FROM (SELECT *, avg(total_revenue) OVER (PARTITION BY series_key) AS mean
                  FROM split_{_suffix} WHERE NOT is_train)
            GROUP BY series_key""",
    }

FILES = {
    "monthly_revenue_second_half":
        f"SELECT * FROM ({REPORTS['monthly_revenue']}) WHERE month(order_month) > 6",
    "quarterly_revenue_second_half":
        f"SELECT * FROM ({REPORTS['quarterly_revenue']}) WHERE quarter > 2",
    "calendar_revenue_second_half":
        f"SELECT * FROM ({REPORTS['calendar_revenue']}) WHERE month(order_month) > 6",
    "csv_series": """
        SELECT series_key, order_month, total_orders,
               CAST(round(total_revenue, 2) AS DOUBLE) AS total_revenue, total_qty,
               unique_customers, round(avg_order_value, 4) AS avg_order_value
        FROM monthly_all""",
    "sql_query": "SELECT countryregion_name, count(*) AS line_count, "
        "count(DISTINCT salesorderid) AS order_count FROM fact_sales GROUP BY ALL",
    "top_products_ascending": "SELECT *, CAST(row_number() OVER (ORDER BY total_revenue "
        f"NULLS FIRST, product_name NULLS FIRST) AS INT) AS place FROM ({REPORTS['top_products']})",
    "revenue_by_country_ascending": "SELECT *, CAST(row_number() OVER (ORDER BY total_revenue "
        f"NULLS FIRST, country) AS INT) AS place FROM ({REPORTS['revenue_by_country']})",
}


# --- linear models --------------------------------------------------------------------
# Normal equations of standardised features, solved by elimination, one pivot per recursion.

WIDTH = len(FEATURES)
# What each candidate adds to the diagonal, from the number n of training rows.
PENALTIES = {"LinearRegression (baseline)": "1e-10 * n", "Ridge": "10.0"}


def _models(name: str, rows: str, penalty: str = PENALTIES["Ridge"]) -> dict[str, str]:
    """Views of fits to ``rows``: (key, fold, place, training, x, y). The last, ``<name>_fit``, has
    (key, fold, level, mean, sd, w)."""
    return {
        f"{name}_rows": rows,
        f"{name}_long": f"""
            SELECT key, fold, place, i, y, x[i] AS v
            FROM {name}_rows, range(1, {WIDTH + 1}) AS _(i) WHERE training""",
        f"{name}_stats": f"""
            SELECT key, fold, i, avg(v) AS mean, CASE WHEN stddev_pop(v) > 1e-9
                THEN stddev_pop(v) END AS sd, avg(y) AS level, count(*) AS n
            FROM {name}_long GROUP BY ALL""",
        f"{name}_unit": f"""
            SELECT key, fold, place, i, coalesce((v - mean) / sd, 0) AS z, y - level AS z_y
            FROM {name}_long JOIN {name}_stats USING (key, fold, i)""",
        f"{name}_lines": f"""
            SELECT key, fold, i, list_append(list(s ORDER BY j), any_value(s_y)) AS line
            FROM (SELECT key, fold, a.i, b.i AS j, sum(a.z * a.z_y) AS s_y, sum(a.z * b.z)
                      + CASE WHEN a.i = b.i THEN any_value({penalty}) ELSE 0 END AS s
                  FROM {name}_unit a JOIN {name}_unit b USING (key, fold, place)
                  JOIN (SELECT DISTINCT key, fold, n FROM {name}_stats) USING (key, fold)
                  GROUP BY key, fold, a.i, b.i)
            GROUP BY ALL""",
        f"{name}_steps": f"""
            SELECT key, fold, 1 AS k, list(line ORDER BY i) AS m FROM {name}_lines
            GROUP BY key, fold
            UNION ALL
            SELECT key, fold, k + 1, list_transform(m, lambda line, i: CASE WHEN i = k
                THEN list_transform(line, lambda v: v / m[k][k])
                ELSE list_transform(line, lambda v, j: v - line[k] * m[k][j] / m[k][k]) END)
            FROM {name}_steps WHERE k <= {WIDTH}""",
        f"{name}_fit": f"""
            SELECT key, fold, any_value(level) AS level, list(mean ORDER BY i) AS mean,
                list(sd ORDER BY i) AS sd, any_value(list_transform(m, lambda line:
                    line[{WIDTH + 1}])) AS w
            FROM {name}_stats JOIN {name}_steps USING (key, fold) WHERE k = {WIDTH + 1}
            GROUP BY key, fold""",
    }


def _predicted(x: str) -> str:
    return (f"level + list_sum(list_transform(range(1, {WIDTH + 1}), lambda i: "
            f"coalesce(w[i] * ({x}[i] - mean[i]) / sd[i], 0.0)))")


SERIES = {"": ("'all'", ""), **{f"_{name}": of for name, of in PANELS.items()}}
LINEAR: dict[str, str] = {}

for _suffix, (_series, _joins) in SERIES.items():
    _whole = f"whole{_suffix or '_all'}"
    VIEWS[_whole] = f"""
        SELECT coalesce(series_key, '(none)') AS key, order_month, trend,
               CAST(total_revenue AS DOUBLE) AS y,
               [{', '.join(f'CAST({name} AS DOUBLE)' for name in FEATURES)}] AS x,
               row_number() OVER (PARTITION BY series_key ORDER BY order_month) - 1 AS place,
               CAST(floor(count(*) OVER (PARTITION BY series_key) * 0.8) AS BIGINT) AS size
        FROM ({_lagged(f"({_dated(f'({_monthly(_series, _joins)})', 12)})", None)})
        WHERE lag_12 IS NOT NULL"""
    _start = "size - (5 - fold) * (size // 6)"
    VIEWS |= _models(f"folds{_suffix or '_all'}", f"""
        SELECT key, fold, place, place < {_start} AS training, x, y
        FROM {_whole}, range(5) AS _(fold)
        WHERE size // 6 > 0 AND place < {_start} + size // 6""")
    VIEWS |= _models(f"final{_suffix or '_all'}",
                     f"SELECT key, 0 AS fold, place, true AS training, x, y FROM {_whole}")
    LINEAR[f"ridge_cv_scores{_suffix}"] = f"""
        SELECT nullif(key, '(none)') AS series_key, CAST(fold AS INT) AS fold,
               round(avg(abs(y - ({_predicted('x')}))), 0) AS mae
        FROM folds{_suffix or '_all'}_rows JOIN folds{_suffix or '_all'}_fit USING (key, fold)
        WHERE NOT training GROUP BY ALL"""
    _next = ("[month(m), quarter(m), year(m), round(sin(2 * pi() * month(m) / 12), 12), "
             "round(cos(2 * pi() * month(m) / 12), 12), "
             "round(sin(2 * pi() * quarter(m) / 4), 12), "
             "round(cos(2 * pi() * quarter(m) / 4), 12), trend, "
             + ", ".join(f"h[-{lag}]" for lag in LAGS) + ", "
             + ", ".join(f"list_aggregate(h[-{size}:], '{name}')"
                         for name in ("avg", "stddev_samp") for size in ROLLING) + "]")
    VIEWS[f"future{_suffix or '_all'}"] = f"""
        SELECT key, 0 AS step, max(order_month) AS m, max(trend) AS trend,
               list(y ORDER BY order_month) AS h FROM {_whole} GROUP BY key
        UNION ALL
        SELECT key, step + 1, m, trend, list_append(h, greatest({_predicted('x')}, 0)) FROM (
            SELECT key, step, m, trend, h, level, mean, sd, w, {_next} AS x
            FROM (SELECT key, step, CAST(m + INTERVAL 1 MONTH AS DATE) AS m, trend + 1 AS trend, h
                  FROM future{_suffix or '_all'} WHERE step < 6)
            JOIN final{_suffix or '_all'}_fit USING (key))"""
    LINEAR[f"ridge_forecast{_suffix}"] = f"""
        SELECT nullif(key, '(none)') AS series_key, m AS order_month,
               round(h[-1], 0) AS predicted_revenue
        FROM future{_suffix or '_all'} WHERE step > 0"""
    for _number, (_model, _penalty) in enumerate(PENALTIES.items()):
        VIEWS |= _models(f"held{_suffix or '_all'}_{_number}", f"""
            SELECT key, 0 AS fold, place, place < size AS training, x, y FROM {_whole}""",
            _penalty)
    _errors = " UNION ALL ".join(f"""
        SELECT key, '{_model}' AS model, {_number} AS rank, avg(abs(y - ({_predicted('x')}))) AS mae
        FROM held{_suffix or '_all'}_{_number}_rows JOIN held{_suffix or '_all'}_{_number}_fit
            USING (key, fold) WHERE NOT training GROUP BY key"""
        for _number, _model in enumerate(PENALTIES))
    LINEAR[f"linear_champion{_suffix}"] = f"""
        SELECT nullif(key, '(none)') AS series_key, arg_min(model, (mae, rank)) AS model
        FROM ({_errors}) GROUP BY key"""

LINEAR["saved_metrics"] = f"""
    SELECT 'Ridge' AS model, round(mae, 2) AS mae, round(rmse, 2) AS rmse, round(mape, 2) AS mape,
           round(r2, 2) AS r2, round(cv_mae_mean, 2) AS cv_mae_mean,
           round(cv_mae_std, 2) AS cv_mae_std
    FROM (SELECT avg(abs(y - p)) AS mae, sqrt(avg((y - p) ** 2)) AS rmse,
                 avg(abs((y - p) / y)) FILTER (WHERE y <> 0) * 100 AS mape,
                 round(1 - sum((y - p) ** 2) / (var_pop(y) * count(y)), 4) AS r2
          FROM (SELECT y, {_predicted('x')} AS p
                FROM held_all_1_rows JOIN held_all_1_fit USING (key, fold) WHERE NOT training)),
         (SELECT avg(mae) AS cv_mae_mean, stddev_pop(mae) AS cv_mae_std
          FROM (SELECT fold, avg(abs(y - ({_predicted('x')}))) AS mae
                FROM folds_all_rows JOIN folds_all_fit USING (key, fold)
                WHERE NOT training GROUP BY fold))"""

LINEAR["saved_model"] = f"""
    SELECT key AS series_key, order_month, round({_predicted('x')}, 2) AS prediction
    FROM whole_all JOIN final_all_fit USING (key)"""


# --- data checks ----------------------------------------------------------------------

def _unique(model: str, column: str) -> str:
    return (f"(SELECT count(*) FROM (SELECT {column} FROM {model} WHERE {column} IS NOT NULL "
            f"GROUP BY {column} HAVING count(*) > 1))")


def _not_null(model: str, column: str) -> str:
    return f"(SELECT count(*) FROM {model} WHERE {column} IS NULL)"


def _orphans(model: str, column: str, parent: str, parent_column: str) -> str:
    return (f"(SELECT count(*) FROM {model} c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{parent_column} = c.{column}))")


def check_rows(kinds: tuple[str, ...]) -> str:
    rows = []
    for model, checks in (SOURCE_CHECKS | MART_CHECKS).items():
        tests = [("unique", c, _unique(model, c)) for c in checks.unique]
        tests += [("not_null", c, _not_null(model, c)) for c in checks.not_null]
        tests += [("relationships", r.column,
                   _orphans(model, r.column, r.parent, r.parent_column))
                  for r in checks.references]
        rows += [f"SELECT '{model}' AS model, '{column}' AS column_name, "
                 f"'{test}' AS test, {failures} AS failures"
                 for test, column, failures in tests if test in kinds]
    return "SELECT *, failures = 0 AS passed FROM (" + " UNION ALL ".join(rows) + ")"


CHECKS = {
    "dq_unique": check_rows(("unique",)),
    "dq_not_null": check_rows(("not_null",)),
    "dq_relationships": check_rows(("relationships",)),
    "dq_report": check_rows(("unique", "not_null", "relationships")),
}


def compose(query: str) -> str:
    """``query`` with the views it needs as common table expressions, in order of use."""
    needed: dict[str, None] = {}

    def visit(sql: str) -> None:
        for name in re.findall(r"\b[a-z]+_\w+\b", sql):
            if name in VIEWS and name not in needed and VIEWS[name] is not sql:
                visit(VIEWS[name])
                needed[name] = None

    visit(query)
    views = ", ".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    return f"WITH RECURSIVE {views} {query}" if views else query


def oracle_sql() -> dict[str, str]:
    plain = {name: f"SELECT * FROM {name}" for name in (*STAGING, *MART_CHECKS)}
    return {name: compose(sql) for name, sql in (
        plain | REPORTS | CUSTOMERS | CHECKS | FORECAST | FILES | LINEAR).items()}
