"""Staging: one function per source table that renames, casts and labels its columns.

No filters and no joins, so every staging frame collapses into the scan below it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import labels
from tradewind.functions.columns import day, translate


def stg_address(address: DataFrame) -> DataFrame:
    return address.select(
        "addressid", "addressline1", "addressline2", "city", "stateprovinceid", "postalcode",
        "spatiallocation", "rowguid", day("modifieddate"))


def stg_countryregion(countryregion: DataFrame) -> DataFrame:
    return countryregion.select(
        "countryregioncode",
        translate("name", labels.COUNTRY_LABELS).alias("countryregion_name"),
        day("modifieddate"))


def stg_creditcard(creditcard: DataFrame) -> DataFrame:
    return creditcard.select(
        "creditcardid", "cardtype", "cardnumber", "expmonth", "expyear", day("modifieddate"))


def stg_customer(customer: DataFrame) -> DataFrame:
    return customer.select(
        "customerid", "personid", "storeid", "territoryid", "rowguid", day("modifieddate"))


def stg_employee(employee: DataFrame) -> DataFrame:
    return employee.select(
        "businessentityid", "nationalidnumber", "loginid",
        translate("jobtitle", labels.JOB_TITLE_LABELS).alias("jobtitle"),
        "birthdate", "maritalstatus", "gender", "hiredate", "salariedflag", "vacationhours",
        "sickleavehours", "currentflag", "rowguid", "modifieddate", "organizationnode",
        day("modifieddate", "modified_date"))


def stg_person(person: DataFrame) -> DataFrame:
    return person.select(
        "businessentityid",
        translate("persontype", labels.PERSON_TYPE_LABELS, labels.UNKNOWN_PERSON_TYPE)
        .alias("persontype"),
        "namestyle", "title", "firstname", "middlename", "lastname", "suffix",
        "emailpromotion", "additionalcontactinfo", "demographics", "rowguid",
        day("modifieddate"))


def stg_product(product: DataFrame) -> DataFrame:
    return product.select(
        "productid", F.col("name").alias("product_name"), "productnumber", "makeflag",
        "finishedgoodsflag", "color", "safetystocklevel", "reorderpoint", "standardcost",
        "listprice", "size", "sizeunitmeasurecode", "weightunitmeasurecode", "weight",
        "daystomanufacture", "productline", "class", "style", "productsubcategoryid",
        "productmodelid", day("sellstartdate"), day("sellenddate"), "discontinueddate",
        "rowguid", day("modifieddate"))


def stg_productcategory(productcategory: DataFrame) -> DataFrame:
    return productcategory.select(
        "productcategoryid",
        translate("name", labels.CATEGORY_LABELS).alias("productcategory_name"),
        "rowguid", day("modifieddate"))


def stg_productsubcategory(productsubcategory: DataFrame) -> DataFrame:
    return productsubcategory.select(
        "productsubcategoryid", "productcategoryid",
        translate("name", labels.SUBCATEGORY_LABELS, labels.OTHER_SUBCATEGORY)
        .alias("productsubcategory_name"),
        "rowguid", day("modifieddate"))


def stg_salesorderdetail(salesorderdetail: DataFrame) -> DataFrame:
    return salesorderdetail.select(
        "salesorderid", "salesorderdetailid", "carriertrackingnumber", "orderqty",
        "productid", "specialofferid", "unitprice", "unitpricediscount", "rowguid",
        day("modifieddate"))


def stg_salesorderheader(salesorderheader: DataFrame) -> DataFrame:
    return salesorderheader.select(
        "salesorderid", "revisionnumber", day("orderdate"), day("duedate"), day("shipdate"),
        translate("status", labels.STATUS_LABELS).alias("statussales"),
        "onlineorderflag", "purchaseordernumber", "accountnumber", "customerid",
        "salespersonid", "territoryid", "billtoaddressid", "shiptoaddressid",
        "shipmethodid", "creditcardid", "creditcardapprovalcode", "currencyrateid",
        "subtotal", "taxamt", "freight", "totaldue", "comment", "rowguid",
        day("modifieddate"))


def stg_salesorderheadersalesreason(salesorderheadersalesreason: DataFrame) -> DataFrame:
    return salesorderheadersalesreason.select(
        "salesorderid", "salesreasonid", day("modifieddate"))


def stg_salesperson(salesperson: DataFrame) -> DataFrame:
    return salesperson.select(
        "businessentityid", "territoryid", "salesquota", "bonus", "commissionpct", "salesytd",
        "saleslastyear", "rowguid", day("modifieddate"))


def stg_salesreason(salesreason: DataFrame) -> DataFrame:
    return salesreason.select(
        "salesreasonid", F.col("name").alias("salesreason_name"), "reasontype",
        day("modifieddate"))


def stg_salesterritory(salesterritory: DataFrame) -> DataFrame:
    return salesterritory.select(
        "territoryid",
        translate("name", labels.TERRITORY_LABELS).alias("territory_name"),
        "countryregioncode", F.col("`group`").alias("territorygroup"), "rowguid",
        day("modifieddate"))


def stg_stateprovince(stateprovince: DataFrame) -> DataFrame:
    return stateprovince.select(
        "stateprovinceid", "stateprovincecode", "countryregioncode",
        "isonlystateprovinceflag", F.col("name").alias("stateprovince_name"), "territoryid",
        "rowguid", day("modifieddate"))


def stg_store(store: DataFrame) -> DataFrame:
    return store.select(
        "businessentityid", F.col("name").alias("namestore"), "salespersonid", "demographics",
        "rowguid", day("modifieddate"))


# staging name -> (source schema, source table, transform)
STAGING: dict[str, tuple[str, str, Callable[[DataFrame], DataFrame]]] = {
    "stg_address": ("person", "address", stg_address),
    "stg_countryregion": ("person", "countryregion", stg_countryregion),
    "stg_creditcard": ("sales", "creditcard", stg_creditcard),
    "stg_customer": ("sales", "customer", stg_customer),
    "stg_employee": ("humanresources", "employee", stg_employee),
    "stg_person": ("person", "person", stg_person),
    "stg_product": ("production", "product", stg_product),
    "stg_productcategory": ("production", "productcategory", stg_productcategory),
    "stg_productsubcategory": ("production", "productsubcategory", stg_productsubcategory),
    "stg_salesorderdetail": ("sales", "salesorderdetail", stg_salesorderdetail),
    "stg_salesorderheader": ("sales", "salesorderheader", stg_salesorderheader),
    "stg_salesorderheadersalesreason":
        ("sales", "salesorderheadersalesreason", stg_salesorderheadersalesreason),
    "stg_salesperson": ("sales", "salesperson", stg_salesperson),
    "stg_salesreason": ("sales", "salesreason", stg_salesreason),
    "stg_salesterritory": ("sales", "salesterritory", stg_salesterritory),
    "stg_stateprovince": ("person", "stateprovince", stg_stateprovince),
    "stg_store": ("sales", "store", stg_store),
}
