"""The order-entry test tables seen as source tables of the warehouse.

Only columns that the warehouse uses are filled.  Ids keep the types of the test
tables.  Everything is read whole; what a warehouse "already holds" is decided
by dates in the data, so unmatched and early-arriving rows occur at every scale.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import typed_null
from ..operators.blocks import value_blocks, with_values

# Dates that separate what is loaded from what is new.
PRODUCTS_KNOWN_UNTIL = datetime(1995, 4, 1)
CUSTOMERS_KNOWN_UNTIL = datetime(1996, 1, 1)
ORDERS_LOADED_UNTIL = datetime(1998, 1, 1)

# A unique order of the lines inside an order.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]

_MONEY = "decimal(19,4)"
_TOTAL = "decimal(22,4)"


def ntz(moment: datetime) -> Column:
    """A literal of the zone-less timestamp type of the test tables."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


class Retail:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- source tables -------------------------------------------------------

    def country_region(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").cast("string").alias("CountryRegionCode"), F.col("r_name").alias("Name")
        )

    def state_province(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("StateProvinceID"),
            F.col("n_nationkey").cast("string").alias("StateProvinceCode"),
            F.col("n_regionkey").cast("string").alias("CountryRegionCode"),
            F.col("n_name").alias("Name"),
        )

    def sales_territory(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("TerritoryID"),
            F.col("n_name").alias("Name"),
            F.col("n_regionkey").cast("string").alias("CountryRegionCode"),
        )

    def address(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("AddressID"),
            F.col("c_name").alias("AddressLine1"),
            F.concat(F.lit("Unit "), F.col("c_custkey").cast("string")).alias("AddressLine2"),
            F.col("c_mktsegment").alias("City"),
            F.col("c_nationkey").alias("StateProvinceID"),
            F.col("c_nationkey").cast("string").alias("PostalCode"),
        )

    def customer(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("CustomerID"), F.col("c_custkey").alias("PersonID")
        )

    def person(self) -> DataFrame:
        """Customers who signed up, last modified when they did so last."""
        signups = (
            self.table("events")
            .filter("event_type = 'signup'")
            .groupBy(F.col("user_id").alias("c_custkey"))
            .agg(F.max("ts").alias("ModifiedDate"))
        )
        return (
            self.table("customer")
            .join(signups, "c_custkey")
            .select(
                F.col("c_custkey").alias("BusinessEntityID"),
                F.col("c_mktsegment").alias("Title"),
                F.col("c_name").alias("FirstName"),
                F.concat(F.lit("of "), F.col("c_mktsegment")).alias("LastName"),
                F.lower("c_mktsegment").alias("MiddleName"),
                F.col("c_nationkey").cast("string").alias("Suffix"),
                "ModifiedDate",
            )
        )

    def email_address(self) -> DataFrame:
        """Users with a high-value click, the last one of which dates their e-mail."""
        return (
            self.table("events")
            .filter("event_type = 'click' AND value > 130")
            .groupBy(F.col("user_id").alias("BusinessEntityID"))
            .agg(F.max("ts").alias("ModifiedDate"))
            .select(
                "BusinessEntityID",
                F.concat(F.lit("user"), F.col("BusinessEntityID").cast("string")).alias("EmailAddress"),
                "ModifiedDate",
            )
        )

    def employee(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("BusinessEntityID"),
            F.col("s_name").alias("JobTitle"),
            (F.col("s_acctbal") > 0).alias("CurrentFlag"),
        )

    def product(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("ProductID"),
            F.col("p_name").alias("Name"),
            F.col("p_brand").alias("ProductNumber"),
            (F.col("p_size") > 25).alias("FinishedGoodsFlag"),
            F.split("p_name", " ")[0].alias("Color"),
            F.col("p_retailprice").cast(_MONEY).alias("StandardCost"),
            F.col("p_retailprice").cast(_MONEY).alias("ListPrice"),
            F.col("p_size").cast("string").alias("Size"),
            F.lower("p_type").alias("ProductLine"),
            F.lower("p_brand").alias("Class"),
            F.col("p_type").alias("Style"),
            typed_null("date").alias("SellStartDate"),
            typed_null("date").alias("SellEndDate"),
            F.col("p_brand").alias("ProductSubcategoryID"),
            F.col("p_size").alias("ProductModelID"),
        )

    def product_subcategory(self) -> DataFrame:
        """Brands that make small parts; other brands belong to no subcategory."""
        return (
            self.table("part")
            .filter("p_size < 3")
            .groupBy(F.col("p_brand").alias("ProductSubcategoryID"))
            .agg(F.min("p_type").alias("ProductCategoryID"))
            .withColumn("Name", F.concat(F.lit("Sub "), F.col("ProductSubcategoryID")))
        )

    def product_category(self) -> DataFrame:
        return (
            self.table("part")
            .filter("p_type <> 'ECONOMY'")
            .select(F.col("p_type").alias("ProductCategoryID"))
            .distinct()
            .withColumn("Name", F.concat(F.lit("Cat "), F.col("ProductCategoryID")))
        )

    def product_model(self) -> DataFrame:
        """One model per size; the smallest are spelled NULL, the largest have none."""
        size = F.col("ProductModelID")
        return (
            self.table("part")
            .filter("p_size <= 40")
            .select(F.col("p_size").alias("ProductModelID"))
            .distinct()
            .withColumn("Name", F.when(size < 10, "NULL").otherwise(F.concat(F.lit("Model "), size.cast("string"))))
        )

    def special_offer(self) -> DataFrame:
        offer = F.round(F.col("l_discount") * 100).cast("int")
        return self.table("lineitem").select(
            offer.alias("SpecialOfferID"),
            F.concat(F.lit("Discount "), offer.cast("string")).alias("Description"),
            F.col("l_discount").cast(_MONEY).alias("DiscountPct"),
            F.col("l_returnflag").alias("Type"),
            typed_null("string").alias("Category"),
            typed_null("date").alias("StartDate"),
            typed_null("date").alias("EndDate"),
            typed_null("int").alias("MinQty"),
            typed_null("int").alias("MaxQty"),
        )

    def sales_order_header(self) -> DataFrame:
        """Orders with totals, dates and parties taken from their lines.

        Totals are summed as whole cents, or hundredths of them, and become decimals per order.
        """
        cents = F.round(F.col("l_extendedprice") * 100).cast("long")
        rate = F.round(F.col("l_tax") * 100).cast("long")
        lines = (
            self.table("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(
                (F.sum(cents) * F.lit(Decimal("0.01"))).cast(_TOTAL).alias("SubTotal"),
                (F.sum(cents * rate) * F.lit(Decimal("0.0001"))).cast(_TOTAL).alias("TaxAmt"),
                F.min("l_shipdate").alias("DueDate"),
                F.max("l_shipdate").alias("ShipDate"),
                F.min("l_suppkey").alias("SalesPersonID"),
                F.max("l_suppkey").alias("ShipToAddressID"),
            )
        )
        customers = self.table("customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("TerritoryID")
        )
        orders, nations = self.table("orders"), value_blocks(customers, "o_custkey", "TerritoryID")
        if nations:  # no shuffle of the orders for their customers
            orders = with_values(orders, nations, "o_custkey", "TerritoryID")
        else:
            orders = orders.join(customers, "o_custkey", "left")
        return (
            orders.join(lines, "o_orderkey", "left")
            .select(
                F.col("o_orderkey").alias("SalesOrderID"),
                F.concat(F.lit("SO"), F.col("o_orderkey").cast("string")).alias("SalesOrderNumber"),
                F.lit(1).alias("RevisionNumber"),
                F.col("o_orderdate").alias("OrderDate"),
                "DueDate",
                "ShipDate",
                F.col("o_custkey").alias("CustomerID"),
                "SalesPersonID",
                "TerritoryID",
                F.col("o_custkey").alias("BillToAddressID"),
                "ShipToAddressID",
                "SubTotal",
                "TaxAmt",
                F.col("o_totalprice").cast(_MONEY).alias("Freight"),
            )
        )

    def sales_order_detail(self, lines: DataFrame | None = None, *more: str) -> DataFrame:
        return (self.table("lineitem") if lines is None else lines).select(
            F.col("l_orderkey").alias("SalesOrderID"),
            F.col("l_quantity").cast("smallint").alias("OrderQty"),
            F.col("l_partkey").alias("ProductID"),
            F.round(F.col("l_discount") * 100).cast("int").alias("SpecialOfferID"),
            F.col("l_extendedprice").cast(_MONEY).alias("UnitPrice"),
            F.col("l_discount").cast(_MONEY).alias("UnitPriceDiscount"),
            F.col("l_extendedprice").cast(_MONEY).alias("LineTotal"),
            *LINE_ORDER,
            *more,
        )

    def sources(self) -> dict[str, DataFrame]:
        return {
            "SpecialOffer": self.special_offer(),
            "Employee": self.employee(),
            "Product": self.product(),
            "ProductSubcategory": self.product_subcategory(),
            "ProductCategory": self.product_category(),
            "ProductModel": self.product_model(),
            "Customer": self.customer(),
            "Person": self.person(),
            "EmailAddress": self.email_address(),
            "SalesTerritory": self.sales_territory(),
            "CountryRegion": self.country_region(),
            "Address": self.address(),
            "StateProvince": self.state_province(),
            "SalesOrderHeader": self.sales_order_header(),
            "SalesOrderDetail": self.sales_order_detail(),
        }

    # -- what a warehouse holds before the load under test ---------------------

    def known_customers(self) -> DataFrame:
        """Customers who ordered before the cut-off, keyed."""
        return (
            self.table("orders")
            .filter(F.col("o_orderdate") < ntz(CUSTOMERS_KNOWN_UNTIL))
            .select(F.col("o_custkey").alias("CustomerAK"))
            .distinct()
            .select((F.col("CustomerAK") + 1).alias("CustomerKey"), "CustomerAK")
        )

    def known_products(self) -> DataFrame:
        """Products shipped before the cut-off, keyed."""
        return (
            self.table("lineitem")
            .filter(F.col("l_shipdate") < ntz(PRODUCTS_KNOWN_UNTIL))
            .select(F.col("l_partkey").alias("ProductAK"))
            .distinct()
            .select((F.col("ProductAK") + 1).alias("ProductKey"), "ProductAK")
        )

    def loaded_lines(self) -> DataFrame:
        """Keys of the order lines that are in the fact table."""
        return self.table("lineitem").filter(F.col("l_shipdate") < ntz(ORDERS_LOADED_UNTIL)).select(
            "l_orderkey", "l_linenumber"
        )

    def order_lines(self) -> DataFrame:
        return self.table("orders").join(
            self.table("lineitem"), F.col("o_orderkey") == F.col("l_orderkey")
        )

    def latest_status(self, until: datetime | None = None) -> DataFrame:
        """Per customer the priority of the latest order, where low priority counts as unknown."""
        orders = self.table("orders")
        if until is not None:
            orders = orders.filter(F.col("o_orderdate") < ntz(until))
        status = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
        return (
            orders.groupBy(F.col("o_custkey").alias("ak"))
            .agg(F.max(F.struct("o_orderdate", "o_orderkey", status.alias("status"))).alias("latest"))
            .select("ak", F.col("latest.status").alias("status"))
        )

    def status_history(self) -> DataFrame:
        """A type-2 dimension of customer status with up to two versions per customer."""
        first = self.latest_status(CUSTOMERS_KNOWN_UNTIL).withColumnRenamed("status", "was")
        both = self.latest_status(ORDERS_LOADED_UNTIL).join(
            first.withColumn("older", F.lit(True)), "ak", "left"
        )
        stays = F.col("older") & F.col("was").eqNullSafe(F.col("status"))
        opened, closed, never = ntz(CUSTOMERS_KNOWN_UNTIL), ntz(ORDERS_LOADED_UNTIL), typed_null("timestamp_ntz")

        def version(number: int, status: str, loaded: Column, expired: Column) -> Column:
            return F.struct(
                (F.col("ak") * 2 + number).alias("k"),
                F.col(status).alias("status"),
                loaded.alias("loaded"),
                expired.alias("expired"),
            )

        versions = (
            F.when(F.col("older").isNull(), F.array(version(2, "status", closed, never)))
            .when(stays, F.array(version(1, "was", opened, never)))
            .otherwise(F.array(version(1, "was", opened, closed), version(2, "status", closed, never)))
        )
        return both.select("ak", F.explode(versions).alias("v")).select("v.k", "ak", "v.status", "v.loaded", "v.expired")

    def waiting_customers(self) -> DataFrame:
        """All customers as a dimension in which those of recent orders are only inferred."""
        customers = self.table("customer").select(
            (F.col("c_custkey") + 1).alias("k"), F.col("c_custkey").alias("ak"), F.col("c_name").alias("name")
        )
        known = self.known_customers().select(F.col("CustomerAK").alias("ak"), F.lit(True).alias("known"))
        waiting = F.col("known").isNull()
        return customers.join(known, "ak", "left").select(
            "k", "ak", F.when(~waiting, F.col("name")).alias("name"), waiting.cast("int").alias("inferred")
        )

    def arrived_customers(self) -> DataFrame:
        """Source rows of the customers who ordered before the later cut-off."""
        ordered = self.table("orders").filter(F.col("o_orderdate") < ntz(ORDERS_LOADED_UNTIL))
        customers = self.table("customer").select(F.col("c_custkey").alias("ak"), F.col("c_name").alias("name"))
        return customers.join(ordered.select(F.col("o_custkey").alias("ak")), "ak", "left_semi")

    def control(self) -> DataFrame:
        """A control table with one flow per event type; the error flow has never succeeded."""
        return (
            self.table("events")
            .groupBy(F.col("event_type").alias("DataFlowName"))
            .agg(F.max("ts").alias("LastSuccessfulModifiedDate"))
            .withColumn(
                "LastSuccessfulModifiedDate",
                F.when(F.col("DataFlowName") != "error", F.col("LastSuccessfulModifiedDate")),
            )
        )
