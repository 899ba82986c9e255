"""Staging frames of the six keyed dimensions.

Each comes with a NULL surrogate key, to be filled when the member is inserted.
Small parents are joined to each other first, so the large table is joined once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import blank_tokens, in_window, typed_null
from ..limits import DEFAULT, Limits
from ..operators.skew import is_small, skew_join
from ..scratch import materialize

# Source column -> promotion attribute.
PROMOTION_COLUMNS = {
    "SpecialOfferID": "PromotionAK",
    "Description": "PromotionName",
    "DiscountPct": "DiscountPercentage",
    "Type": "PromotionType",
    "Category": "PromotionCategory",
    "StartDate": "PromotionStartDate",
    "EndDate": "PromotionEndDate",
    "MinQty": "MinQuantity",
    "MaxQty": "MaxQuantity",
}

# Fixed value: spellings of NULL in model names.
MODEL_NULL_TOKENS = ["NULL"]

_NAMES = ["Title", "FirstName", "LastName", "MiddleName", "Suffix"]


def _unkeyed(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(key, typed_null("bigint"))


def _countries(country_region: DataFrame, prefix: str) -> DataFrame:
    return country_region.select(
        F.col("CountryRegionCode").alias(f"{prefix}CountryRegionCode"),
        F.col("Name").alias(f"{prefix}CountryRegionName"),
    )


def geography_dimension(
    address: DataFrame, state_province: DataFrame, country_region: DataFrame, limits: Limits = DEFAULT
) -> DataFrame:
    """Addresses with their state and country; an address without either is left out."""
    states = state_province.select(
        "StateProvinceID", "StateProvinceCode", F.col("Name").alias("StateProvinceName"), "CountryRegionCode"
    )
    places = skew_join(states, _countries(country_region, ""), "CountryRegionCode", "inner", limits)
    lines = address.select(
        F.col("AddressID").alias("GeographyAK"),
        "AddressLine1",
        "AddressLine2",
        "City",
        "StateProvinceID",
        "PostalCode",
    )
    return _unkeyed(skew_join(lines, places, "StateProvinceID", "inner", limits).drop("StateProvinceID"), "GeographyKey")


def territory_dimension(sales_territory: DataFrame, country_region: DataFrame, limits: Limits = DEFAULT) -> DataFrame:
    """Sales territories with the name of their country."""
    territories = sales_territory.select(
        F.col("TerritoryID").alias("SalesTerritoryAK"),
        F.col("Name").alias("SalesTerritoryName"),
        F.col("CountryRegionCode").alias("SalesCountryRegionCode"),
    )
    named = skew_join(territories, _countries(country_region, "Sales"), "SalesCountryRegionCode", "inner", limits)
    return _unkeyed(named, "SalesTerritoryKey")


def product_dimension(
    product: DataFrame,
    subcategory: DataFrame,
    category: DataFrame,
    model: DataFrame,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Products with subcategory, category and model names; every product stays, named or not."""
    categories = category.select("ProductCategoryID", F.col("Name").alias("ProductCategoryName"))
    subcategories = subcategory.select(
        "ProductSubcategoryID", "ProductCategoryID", F.col("Name").alias("ProductSubCategoryName")
    )
    groups = skew_join(subcategories, categories, "ProductCategoryID", "left", limits).drop("ProductCategoryID")
    models = model.select("ProductModelID", F.col("Name").alias("ProductModelName"))
    products = product.select(
        F.col("ProductID").alias("ProductAK"),
        "ProductNumber",
        F.col("Name").alias("ProductName"),
        "FinishedGoodsFlag",
        "Color",
        "StandardCost",
        "ListPrice",
        "Size",
        "ProductLine",
        "Class",
        "Style",
        "SellStartDate",
        "SellEndDate",
        "ProductSubcategoryID",
        "ProductModelID",
    )
    grouped = skew_join(products, groups, "ProductSubcategoryID", "left", limits).drop("ProductSubcategoryID")
    named = skew_join(grouped, models, "ProductModelID", "left", limits).drop("ProductModelID")
    return _unkeyed(blank_tokens(named, {"ProductModelName": MODEL_NULL_TOKENS}), "ProductKey")


def promotion_dimension(special_offer: DataFrame) -> DataFrame:
    """Offers under their dimension names, without repeated rows."""
    renamed = special_offer.select(*PROMOTION_COLUMNS).withColumnsRenamed(PROMOTION_COLUMNS)
    return _unkeyed(renamed.dropDuplicates(), "PromotionKey")


def _email(email_address: DataFrame) -> DataFrame:
    return email_address.select("BusinessEntityID", "EmailAddress", F.col("ModifiedDate").alias("_email_changed"))


def _versioned(df: DataFrame, run_ts) -> DataFrame:
    return df.withColumns({"LoadDate": F.lit(run_ts), "ExpirationDate": typed_null("timestamp")})


def employee_dimension(
    employee: DataFrame, person: DataFrame, email_address: DataFrame, run_ts, limits: Limits = DEFAULT
) -> DataFrame:
    """Employees with name and e-mail where known."""
    staff = employee.select("BusinessEntityID", "JobTitle", "CurrentFlag")
    named = skew_join(staff, person.select("BusinessEntityID", *_NAMES), "BusinessEntityID", "left", limits)
    mailed = skew_join(named, _email(email_address).drop("_email_changed"), "BusinessEntityID", "left", limits)
    columns = mailed.withColumnRenamed("BusinessEntityID", "EmployeeAK")
    return _unkeyed(_versioned(columns, run_ts), "EmployeeKey")


def changed_people(person: DataFrame, email_address: DataFrame, low) -> DataFrame:
    """Keys of people whose person or e-mail row was modified after ``low``.

    Each table is filtered on its own date, so the filter reaches its scan; a filter on the joined rows would not.
    """
    keys = [df.filter(F.col("ModifiedDate") > F.lit(low)).select("BusinessEntityID") for df in (person, email_address)]
    return keys[0].unionByName(keys[1]).filter("BusinessEntityID is not null").distinct()


def customer_dimension(
    customer: DataFrame,
    person: DataFrame,
    email_address: DataFrame,
    low,
    high,
    run_ts,
    strict: bool = False,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Customers whose person or e-mail row was modified in the window after ``low`` up to ``high``.

    A customer without a person row is left out; facts bring it in as an inferred member.
    Where few people changed, proven by the size of their keys, only their rows enter the joins.
    """
    touched = materialize(changed_people(person, email_address, low), "changed_people")
    few = is_small(touched, limits)
    only = lambda df: skew_join(df, touched, "BusinessEntityID", "left_semi", limits, small=True) if few else df
    buyers = customer.select(F.col("CustomerID").alias("CustomerAK"), F.col("PersonID").alias("BusinessEntityID"))
    people = person.select("BusinessEntityID", *_NAMES, F.col("ModifiedDate").alias("_person_changed"))
    named = skew_join(only(buyers), only(people), "BusinessEntityID", "inner", limits)
    mailed = skew_join(named, only(_email(email_address)), "BusinessEntityID", "left", limits)
    recent = mailed.filter(in_window([F.col("_email_changed"), F.col("_person_changed")], low, high, strict))
    columns = recent.drop("BusinessEntityID", "_email_changed", "_person_changed")
    flagged = _versioned(columns, run_ts).withColumn("Inferred", F.lit(0).cast("tinyint"))
    return _unkeyed(flagged, "CustomerKey")
