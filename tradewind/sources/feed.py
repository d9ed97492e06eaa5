"""Presents an order-processing feed (orders, lineitem, part, ...) as the source tables.

Each source table is a projection of ONE feed table, so reading it adds no join and
column pruning and filters still reach the Parquet scan. The expressions are plain SQL
that other SQL engines evaluate to the same values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tradewind.functions.labels import SUBCATEGORY_LABELS

# Columns of the feed tables. Given to the reader, so that planning opens no files.
FEED_TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
              "o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}

MODIFIED = "cast(date '1995-01-01' as timestamp)"


def _amount(expression: str) -> str:
    return f"cast(cast({expression} as decimal(15,2)) as decimal(19,4))"


def _choose(expression: str, values: dict[int, str], otherwise: str) -> str:
    branches = " ".join(f"when {key} then '{value}'" for key, value in values.items())
    return f"case {expression} {branches} else {otherwise} end"


def _subcategory_names() -> dict[int, str]:
    """25 subcategory names, one of them without a label."""
    names = [*SUBCATEGORY_LABELS, "Saddle Bags"]
    return {number: names[(number - 1) * 7 % len(names)] for number in range(1, 26)}


@dataclass(frozen=True)
class Mapping:
    feed: str
    columns: dict[str, str]


def _null(type_name: str) -> str:
    return f"cast(null as {type_name})"


_TOTAL = "cast(o_totalprice as decimal(15,2))"
_PRICE = "cast(p_retailprice as decimal(15,2))"

FEED: dict[tuple[str, str], Mapping] = {
    ("humanresources", "employee"): Mapping("supplier", {
        "businessentityid": "s_suppkey",
        "nationalidnumber": "cast(s_suppkey as string)",
        "loginid": "s_name",
        "jobtitle": _choose("s_suppkey % 5", {
            0: "North American Sales Manager",
            1: "Sales Representative",
            2: "European Sales Manager",
            3: "Pacific Sales Manager",
        }, "'Buyer'"),
        "birthdate": _null("date"),
        "maritalstatus": _null("string"),
        "gender": _choose("s_suppkey % 2", {0: "F"}, "'M'"),
        "hiredate": _null("date"),
        "salariedflag": "true",
        "vacationhours": _null("int"),
        "sickleavehours": _null("int"),
        "currentflag": "true",
        "rowguid": _null("string"),
        "modifieddate": MODIFIED,
        "organizationnode": _null("string"),
    }),
    ("person", "address"): Mapping("customer", {
        "addressid": "c_custkey",
        "addressline1": "c_name",
        "addressline2": _null("string"),
        "city": "'City ' || cast(c_nationkey as string)",
        "stateprovinceid": "cast(c_nationkey as bigint)",
        "postalcode": "cast(10000 + c_custkey as string)",
        "spatiallocation": _null("string"),
        "rowguid": _null("string"),
        "modifieddate": MODIFIED,
    }),
    ("person", "countryregion"): Mapping("region", {
        "countryregioncode": "cast(r_regionkey as string)",
        "name": _choose("r_regionkey", {
            0: "France", 1: "Canada", 2: "United States", 3: "Germany",
        }, "r_name"),
        "modifieddate": MODIFIED,
    }),
    ("person", "person"): Mapping("customer", {
        "businessentityid": "c_custkey",
        "persontype": _choose("c_custkey % 7", {
            0: "SC", 1: "IN", 2: "SP", 3: "EM", 4: "VC", 5: "GC",
        }, "'XX'"),
        "namestyle": "false",
        "title": _null("string"),
        "firstname": "c_name",
        "middlename": _null("string"),
        "lastname": "c_mktsegment",
        "suffix": _null("string"),
        "emailpromotion": "0",
        "additionalcontactinfo": _null("string"),
        "demographics": _null("string"),
        "rowguid": _null("string"),
        "modifieddate": MODIFIED,
    }),
    ("person", "stateprovince"): Mapping("nation", {
        "stateprovinceid": "cast(n_nationkey as bigint)",
        "stateprovincecode": "cast(n_nationkey as string)",
        "countryregioncode": "cast(n_regionkey as string)",
        "isonlystateprovinceflag": "false",
        "name": "n_name",
        "territoryid": "n_regionkey",
        "rowguid": _null("string"),
        "modifieddate": MODIFIED,
    }),
    ("production", "product"): Mapping("part", {
        "productid": "p_partkey",
        "name": "p_name",
        "productnumber": "p_brand",
        "makeflag": "true",
        "finishedgoodsflag": "true",
        "color": _null("string"),
        "safetystocklevel": _null("int"),
        "reorderpoint": _null("int"),
        "standardcost": f"cast({_PRICE} * 0.60 as decimal(19,4))",
        "listprice": _amount("p_retailprice"),
        "size": "cast(p_size as string)",
        "sizeunitmeasurecode": _null("string"),
        "weightunitmeasurecode": _null("string"),
        "weight": _null("decimal(8,2)"),
        "daystomanufacture": "0",
        "productline": _null("string"),
        "class": "p_type",
        "style": _null("string"),
        "productsubcategoryid":
            "case when p_size % 10 = 0 then null else cast(substring(p_brand, 7) as int) end",
        "productmodelid": _null("int"),
        "sellstartdate": MODIFIED,
        "sellenddate": _null("timestamp"),
        "discontinueddate": _null("timestamp"),
        "rowguid": _null("string"),
        "modifieddate": MODIFIED,
    }),
    ("production", "productcategory"): Mapping("region", {
        "productcategoryid": "r_regionkey + 1",
        "name": _choose("r_regionkey", {
            0: "Accessories", 1: "Bikes", 2: "Clothing", 3: "Components",
        }, "r_name"),
        "rowguid": _null("string"),
        "modifieddate": MODIFIED,
    }),
    ("production", "productsubcategory"): Mapping("nation", {
        "productsubcategoryid": "n_nationkey + 1",
        "productcategoryid": "(n_nationkey + 1) % 4 + 1",
        "name": _choose("n_nationkey + 1", _subcategory_names(), "n_name"),
        "rowguid": _null("string"),
        "modifieddate": MODIFIED,
    }),
    ("sales", "creditcard"): Mapping("customer", {
        "creditcardid": "c_custkey",
        "cardtype": "c_mktsegment",
        "cardnumber": "cast(100000000 + c_custkey as string)",
        "expmonth": "cast(c_custkey % 12 + 1 as int)",
        "expyear": "cast(c_custkey % 4 + 2005 as int)",
        "modifieddate": MODIFIED,
    }),
    ("sales", "customer"): Mapping("customer", {
        "customerid": "c_custkey",
        "personid": "case when c_custkey % 50 = 7 then null else c_custkey end",
        "storeid": "case when c_mktsegment = 'BUILDING' then c_custkey end",
        "territoryid": "cast(c_custkey % 5 as int)",
        "rowguid": _null("string"),
        "modifieddate": MODIFIED,
    }),
    ("sales", "salesorderdetail"): Mapping("lineitem", {
        "salesorderid": "l_orderkey",
        "salesorderdetailid": "cast(l_linenumber as bigint)",
        "carriertrackingnumber": _null("string"),
        "orderqty": "cast(l_quantity as int)",
        "productid": "l_partkey",
        "specialofferid": "1",
        "unitprice": _amount("l_extendedprice"),
        "unitpricediscount": "cast(l_discount as decimal(19,4))",
        "rowguid": _null("string"),
        "modifieddate": "l_shipdate",
    }),
    ("sales", "salesorderheader"): Mapping("orders", {
        "salesorderid": "o_orderkey",
        "revisionnumber": "1",
        "orderdate": "o_orderdate",
        "duedate": "o_orderdate + interval 14 day",
        "shipdate": "o_orderdate + interval 7 day",
        "status": "cast(o_orderkey % 7 + 1 as int)",
        "onlineorderflag": "o_orderpriority not in ('1-URGENT', '2-HIGH')",
        "purchaseordernumber": _null("string"),
        "accountnumber": _null("string"),
        "customerid": "o_custkey",
        "salespersonid":
            "case when o_orderpriority in ('1-URGENT', '2-HIGH') then o_orderkey % 10 end",
        "territoryid": "cast(o_custkey % 5 as int)",
        "billtoaddressid": "o_custkey",
        "shiptoaddressid": "o_custkey",
        "shipmethodid": "1",
        "creditcardid": "case when o_orderkey % 4 = 0 then null else o_custkey end",
        "creditcardapprovalcode": _null("string"),
        "currencyrateid": _null("int"),
        "subtotal": f"cast({_TOTAL} * 0.90 as decimal(19,4))",
        "taxamt": f"cast({_TOTAL} * 0.08 as decimal(19,4))",
        "freight": f"cast({_TOTAL} * 0.02 as decimal(19,4))",
        "totaldue": _amount("o_totalprice"),
        "comment": _null("string"),
        "rowguid": _null("string"),
        "modifieddate": "o_orderdate",
    }),
    ("sales", "salesorderheadersalesreason"): Mapping("lineitem", {
        "salesorderid": "l_orderkey",
        "salesreasonid": "l_linenumber",
        "modifieddate": "l_shipdate",
    }),
    ("sales", "salesperson"): Mapping("supplier", {
        "businessentityid": "s_suppkey",
        "territoryid": "cast(s_suppkey % 5 as int)",
        "salesquota": _null("decimal(19,4)"),
        "bonus": "cast(0 as decimal(19,4))",
        "commissionpct": "cast(0 as decimal(10,4))",
        "salesytd": _amount("s_acctbal"),
        "saleslastyear": _null("decimal(19,4)"),
        "rowguid": _null("string"),
        "modifieddate": MODIFIED,
    }),
    ("sales", "salesreason"): Mapping("nation", {
        "salesreasonid": "n_nationkey + 1",
        "name": _choose("n_nationkey + 1", {
            1: "Price", 2: "On Promotion", 3: "Manufacturer", 4: "Review", 5: "Quality",
            6: "Television Advertisement", 7: "Other",
        }, "n_name"),
        "reasontype": _choose("n_nationkey + 1", {2: "Promotion", 6: "Marketing"}, "'Other'"),
        "modifieddate": MODIFIED,
    }),
    ("sales", "salesterritory"): Mapping("region", {
        "territoryid": "r_regionkey",
        "name": _choose("r_regionkey", {
            0: "Southeast", 1: "Northwest", 2: "Central", 3: "Australia",
        }, "r_name"),
        "countryregioncode": "cast(r_regionkey as string)",
        "group": "r_name",
        "rowguid": _null("string"),
        "modifieddate": MODIFIED,
    }),
    ("sales", "store"): Mapping("customer", {
        "businessentityid": "c_custkey",
        "name": "'Store ' || c_name",
        "salespersonid": _null("bigint"),
        "demographics": _null("string"),
        "rowguid": _null("string"),
        "modifieddate": MODIFIED,
    }),
}


class OrdersFeed:
    """Source over a folder of feed tables, one Parquet file or folder each."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, schema: str, name: str) -> DataFrame:
        mapping = FEED[schema, name]
        rows = (self.spark.read.schema(FEED_TABLES[mapping.feed])
                .parquet(f"{self.folder}/{mapping.feed}.parquet"))
        return rows.selectExpr(
            *(f"{expression} as `{column}`" for column, expression in mapping.columns.items()))
