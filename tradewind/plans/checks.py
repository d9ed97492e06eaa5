"""The checks declared for the source tables and the marts."""

from __future__ import annotations

from tradewind.operators.quality import Checks, Reference


def _key(column: str) -> Checks:
    return Checks(unique=(column,), not_null=(column,))


# Declared keys of the source tables, by staging name.
SOURCE_CHECKS: dict[str, Checks] = {
    "stg_employee": _key("businessentityid"),
    "stg_address": _key("addressid"),
    "stg_countryregion": _key("countryregioncode"),
    "stg_person": _key("businessentityid"),
    "stg_stateprovince": _key("stateprovinceid"),
    "stg_product": _key("productid"),
    "stg_productcategory": _key("productcategoryid"),
    "stg_productsubcategory": _key("productsubcategoryid"),
    "stg_salesorderheader": _key("salesorderid"),
    "stg_salesorderdetail": Checks(not_null=("salesorderid",)),
    "stg_salesreason": _key("salesreasonid"),
    "stg_salesorderheadersalesreason": Checks(not_null=("salesorderid",)),
    "stg_salesperson": _key("businessentityid"),
    "stg_salesterritory": _key("territoryid"),
    "stg_creditcard": _key("creditcardid"),
    "stg_store": _key("businessentityid"),
    "stg_customer": _key("customerid"),
}

MART_CHECKS: dict[str, Checks] = {
    "dim_creditcards": Checks(
        unique=("creditcardsk", "creditcardid"),
        not_null=("creditcardsk", "creditcardid", "cardtype")),
    "dim_customers": Checks(
        unique=("customersk", "customerid"),
        not_null=("customersk", "customerid", "customerfirstname", "customerlastname",
                  "customerfullname", "customerpersontype")),
    "dim_dates": Checks(
        unique=("metric_date",),
        not_null=("metric_date", "metric_day", "metric_month", "metric_year",
                  "metric_quarter", "semester", "dayofweek", "fullmonth")),
    "dim_locations": Checks(
        unique=("locationsk", "addressid"),
        not_null=("locationsk", "addressid", "city", "postalcode", "stateprovincecode",
                  "stateprovince_name", "territory_name", "countryregioncode",
                  "countryregion_name")),
    "dim_products": Checks(
        unique=("productsk", "productid"),
        not_null=("productsk", "productid", "product_name", "productsubcategory_name",
                  "productcategory_name")),
    "dim_reasons": Checks(
        not_null=("reasonsk", "salesorderid", "salesreason_name", "reasontype", "price",
                  "manufacturer", "quality", "promotion", "review", "other", "television")),
    "fact_aggsalessellersregion": Checks(
        unique=("agg_salesregionpersonsk",),
        not_null=("agg_salesregionpersonsk", "countryregion_name", "jobtitle", "gender",
                  "totalsalesorders")),
    "fact_sales": Checks(
        unique=("factsalessk",),
        not_null=("factsalessk", "salesorderid", "customerfk", "locationfk", "productfk",
                  "orderdate", "shipdate", "statussales", "onlineorderflag", "subtotal",
                  "taxamt", "freight", "totaldue", "orderqty", "unitprice",
                  "unitpricediscount", "amountpaidproduct"),
        references=(
            Reference("customerfk", "dim_customers", "customersk"),
            Reference("locationfk", "dim_locations", "locationsk"),
            Reference("creditcardfk", "dim_creditcards", "creditcardsk"),
            Reference("reasonfk", "dim_reasons", "reasonsk"),
            Reference("productfk", "dim_products", "productsk"),
            Reference("orderdate", "dim_dates", "metric_date"))),
}
