"""The 17 source tables and the readers that provide them.

A source is any object with ``table(schema, name) -> DataFrame``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# (schema, table) -> columns with their types
TABLES: dict[tuple[str, str], str] = {
    ("humanresources", "employee"): """
        businessentityid BIGINT, nationalidnumber STRING, loginid STRING, jobtitle STRING,
        birthdate DATE, maritalstatus STRING, gender STRING, hiredate DATE,
        salariedflag BOOLEAN, vacationhours INT, sickleavehours INT, currentflag BOOLEAN,
        rowguid STRING, modifieddate TIMESTAMP, organizationnode STRING""",
    ("person", "address"): """
        addressid BIGINT, addressline1 STRING, addressline2 STRING, city STRING,
        stateprovinceid BIGINT, postalcode STRING, spatiallocation STRING, rowguid STRING,
        modifieddate TIMESTAMP""",
    ("person", "countryregion"): """
        countryregioncode STRING, name STRING, modifieddate TIMESTAMP""",
    ("person", "person"): """
        businessentityid BIGINT, persontype STRING, namestyle BOOLEAN, title STRING,
        firstname STRING, middlename STRING, lastname STRING, suffix STRING,
        emailpromotion INT, additionalcontactinfo STRING, demographics STRING,
        rowguid STRING, modifieddate TIMESTAMP""",
    ("person", "stateprovince"): """
        stateprovinceid BIGINT, stateprovincecode STRING, countryregioncode STRING,
        isonlystateprovinceflag BOOLEAN, name STRING, territoryid INT, rowguid STRING,
        modifieddate TIMESTAMP""",
    ("production", "product"): """
        productid BIGINT, name STRING, productnumber STRING, makeflag BOOLEAN,
        finishedgoodsflag BOOLEAN, color STRING, safetystocklevel INT, reorderpoint INT,
        standardcost DECIMAL(19,4), listprice DECIMAL(19,4), size STRING,
        sizeunitmeasurecode STRING, weightunitmeasurecode STRING, weight DECIMAL(8,2),
        daystomanufacture INT, productline STRING, class STRING, style STRING,
        productsubcategoryid INT, productmodelid INT, sellstartdate TIMESTAMP,
        sellenddate TIMESTAMP, discontinueddate TIMESTAMP, rowguid STRING,
        modifieddate TIMESTAMP""",
    ("production", "productcategory"): """
        productcategoryid INT, name STRING, rowguid STRING, modifieddate TIMESTAMP""",
    ("production", "productsubcategory"): """
        productsubcategoryid INT, productcategoryid INT, name STRING, rowguid STRING,
        modifieddate TIMESTAMP""",
    ("sales", "creditcard"): """
        creditcardid BIGINT, cardtype STRING, cardnumber STRING, expmonth INT, expyear INT,
        modifieddate TIMESTAMP""",
    ("sales", "customer"): """
        customerid BIGINT, personid BIGINT, storeid BIGINT, territoryid INT, rowguid STRING,
        modifieddate TIMESTAMP""",
    ("sales", "salesorderdetail"): """
        salesorderid BIGINT, salesorderdetailid BIGINT, carriertrackingnumber STRING,
        orderqty INT, productid BIGINT, specialofferid INT, unitprice DECIMAL(19,4),
        unitpricediscount DECIMAL(19,4), rowguid STRING, modifieddate TIMESTAMP""",
    ("sales", "salesorderheader"): """
        salesorderid BIGINT, revisionnumber INT, orderdate TIMESTAMP, duedate TIMESTAMP,
        shipdate TIMESTAMP, status INT, onlineorderflag BOOLEAN, purchaseordernumber STRING,
        accountnumber STRING, customerid BIGINT, salespersonid BIGINT, territoryid INT,
        billtoaddressid BIGINT, shiptoaddressid BIGINT, shipmethodid INT,
        creditcardid BIGINT, creditcardapprovalcode STRING, currencyrateid INT,
        subtotal DECIMAL(19,4), taxamt DECIMAL(19,4), freight DECIMAL(19,4),
        totaldue DECIMAL(19,4), comment STRING, rowguid STRING, modifieddate TIMESTAMP""",
    ("sales", "salesorderheadersalesreason"): """
        salesorderid BIGINT, salesreasonid INT, modifieddate TIMESTAMP""",
    ("sales", "salesperson"): """
        businessentityid BIGINT, territoryid INT, salesquota DECIMAL(19,4),
        bonus DECIMAL(19,4), commissionpct DECIMAL(10,4), salesytd DECIMAL(19,4),
        saleslastyear DECIMAL(19,4), rowguid STRING, modifieddate TIMESTAMP""",
    ("sales", "salesreason"): """
        salesreasonid INT, name STRING, reasontype STRING, modifieddate TIMESTAMP""",
    ("sales", "salesterritory"): """
        territoryid INT, name STRING, countryregioncode STRING, `group` STRING,
        rowguid STRING, modifieddate TIMESTAMP""",
    ("sales", "store"): """
        businessentityid BIGINT, name STRING, salespersonid BIGINT, demographics STRING,
        rowguid STRING, modifieddate TIMESTAMP""",
}


class ParquetSource:
    """Tables as Parquet folders ``<root>/<schema>/<table>``, read with a fixed schema."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def table(self, schema: str, name: str) -> DataFrame:
        columns = TABLES[schema, name]
        return self.spark.read.schema(columns).parquet(f"{self.root}/{schema}/{name}")


class CatalogSource:
    """Tables registered in the Spark catalog, one database per source schema."""

    def __init__(self, spark: SparkSession, databases: dict[str, str] | None = None):
        self.spark = spark
        self.databases = databases or {}

    def table(self, schema: str, name: str) -> DataFrame:
        if (schema, name) not in TABLES:
            raise KeyError(f"{schema}.{name} is not a source table")
        return self.spark.table(f"{self.databases.get(schema, schema)}.{name}")


class FrameSource:
    """Tables held as DataFrames; missing ones are empty. Used for small literal inputs."""

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame]):
        self.spark = spark
        self.frames = frames

    def table(self, schema: str, name: str) -> DataFrame:
        frame = self.frames.get(name)
        return frame if frame is not None else self.spark.createDataFrame([], TABLES[schema, name])
