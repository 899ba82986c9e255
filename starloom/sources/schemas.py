"""Declared layouts of source files and warehouse tables.

Fixed values: column names and their order decide how headerless files bind and
what a loaded warehouse looks like to its readers.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

MONEY = "DECIMAL(19,4)"
STORED = "DECIMAL(10,2)"
KEY = "BIGINT"  # surrogate and alternative keys: history can outgrow 32 bits

# Source files: headerless, tab-separated, bound by position.
SOURCE_TABLES = {
    "SpecialOffer": f"SpecialOfferID INT, Description STRING, DiscountPct {MONEY}, Type STRING, Category STRING, "
    "StartDate DATE, EndDate DATE, MinQty INT, MaxQty INT, rowguid STRING, ModifiedDate DATE",
    "Employee": "BusinessEntityID INT, NationalIDNumber STRING, LoginID STRING, OrganizationNode STRING, "
    "OrganizationLevel INT, JobTitle STRING, BirthDate DATE, MaritalStatus STRING, Gender STRING, HireDate DATE, "
    "SalariedFlag BOOLEAN, VacationHours SMALLINT, SickLeaveHours SMALLINT, CurrentFlag BOOLEAN, rowguid STRING, "
    "ModifiedDate TIMESTAMP",
    "Product": "ProductID INT, Name STRING, ProductNumber STRING, MakeFlag INT, FinishedGoodsFlag BOOLEAN, "
    f"Color STRING, SafetyStockLevel INT, ReorderPoint INT, StandardCost {MONEY}, ListPrice {MONEY}, Size STRING, "
    "SizeUnitMeasureCode STRING, WeightUnitMeasureCode STRING, Weight FLOAT, DaysToManufacture INT, "
    "ProductLine STRING, Class STRING, Style STRING, ProductSubcategoryID INT, ProductModelID INT, "
    "SellStartDate DATE, SellEndDate DATE, DiscontinuedDate DATE, rowguid STRING, ModifiedDate DATE",
    "ProductSubcategory": "ProductSubcategoryID INT, ProductCategoryID INT, Name STRING, rowguid STRING, "
    "ModifiedDate DATE",
    "ProductCategory": "ProductCategoryID INT, Name STRING, rowguid STRING, ModifiedDate DATE",
    "ProductModel": "ProductModelID INT, Name STRING, CatalogDescription STRING, Instructions STRING, "
    "rowguid STRING, ModifiedDate TIMESTAMP",
    "Customer": "CustomerID INT, PersonID INT, StoreID INT, TerritoryID INT, AccountNumber STRING, rowguid STRING, "
    "ModifiedDate DATE",
    "Person": "BusinessEntityID INT, PersonType STRING, NameStyle INT, Title STRING, FirstName STRING, "
    "MiddleName STRING, LastName STRING, Suffix STRING, EmailPromotion INT, AdditionalContactInfo STRING, "
    "Demographics STRING, rowguid STRING, ModifiedDate TIMESTAMP",
    "EmailAddress": "BusinessEntityID INT, EmailAddressID INT, EmailAddress STRING, rowguid STRING, "
    "ModifiedDate TIMESTAMP",
    "SalesTerritory": f"TerritoryID INT, Name STRING, CountryRegionCode STRING, `[Group]` STRING, SalesYTD {MONEY}, "
    f"SalesLastYear {MONEY}, CostYTD {MONEY}, CostLastYear {MONEY}, rowguid STRING, ModifiedDate DATE",
    "CountryRegion": "CountryRegionCode STRING, Name STRING, ModifiedDate TIMESTAMP",
    "Address": "AddressID INT, AddressLine1 STRING, AddressLine2 STRING, City STRING, StateProvinceID INT, "
    "PostalCode STRING, SpatialLocation STRING, rowguid STRING, ModifiedDate TIMESTAMP",
    "StateProvince": "StateProvinceID INT, StateProvinceCode STRING, CountryRegionCode STRING, "
    "IsOnlyStateProvinceFlag INT, Name STRING, TerritoryID INT, rowguid STRING, ModifiedDate TIMESTAMP",
    "SalesOrderHeader": "SalesOrderID INT, RevisionNumber INT, OrderDate TIMESTAMP, DueDate TIMESTAMP, "
    "ShipDate TIMESTAMP, Status INT, OnlineOrderFlag INT, SalesOrderNumber STRING, PurchaseOrderNumber STRING, "
    "AccountNumber STRING, CustomerID INT, SalesPersonID INT, TerritoryID INT, BillToAddressID INT, "
    "ShipToAddressID INT, ShipMethodID INT, CreditCardID INT, CreditCardApprovalCode STRING, CurrencyRateID INT, "
    f"SubTotal {MONEY}, TaxAmt {MONEY}, Freight {MONEY}, TotalDue {MONEY}, Comment STRING, rowguid STRING, "
    "ModifiedDate TIMESTAMP",
    "SalesOrderDetail": "SalesOrderID INT, SalesOrderDetailID INT, CarrierTrackingNumber STRING, OrderQty SMALLINT, "
    f"ProductID INT, SpecialOfferID INT, UnitPrice {MONEY}, UnitPriceDiscount {MONEY}, LineTotal {MONEY}, "
    "rowguid STRING, ModifiedDate TIMESTAMP",
}

# Integer columns that an export may write as "776.0", because they hold NULLs.
FLOAT_WRITTEN_IDS = {
    "Product": ["ProductSubcategoryID", "ProductModelID"],
    "Customer": ["PersonID", "StoreID", "TerritoryID"],
}

# Which source files each staging set is built from.
STAGING_SOURCES = {
    "promotion": ["SpecialOffer"],
    "customer": ["Customer", "Person", "EmailAddress"],
    "employee": ["Employee", "Person", "EmailAddress"],
    "geography": ["Address", "StateProvince", "CountryRegion"],
    "territory": ["SalesTerritory", "CountryRegion"],
    "product": ["Product", "ProductSubcategory", "ProductCategory", "ProductModel"],
    "sales": ["Product", "SalesOrderHeader", "SalesOrderDetail"],
}

# Warehouse tables.
WAREHOUSE_TABLES = {
    "DataFlow": "DataFlowName STRING, LastSuccessfulModifiedDate TIMESTAMP",
    "DimCustomer": f"CustomerKey {KEY}, CustomerAK {KEY}, Title STRING, FirstName STRING, MiddleName STRING, "
    "LastName STRING, Suffix STRING, EmailAddress STRING, ExpirationDate TIMESTAMP, LoadDate TIMESTAMP, "
    "Inferred TINYINT",
    "DimProduct": f"ProductKey {KEY}, ProductAK {KEY}, ProductName STRING, ProductNumber STRING, "
    "ProductSubCategoryName STRING, ProductCategoryName STRING, FinishedGoodsFlag BOOLEAN, Color STRING, "
    f"StandardCost {STORED}, ListPrice {STORED}, Size STRING, ProductLine STRING, Class STRING, Style STRING, "
    "ProductModelName STRING, SellStartDate TIMESTAMP, SellEndDate TIMESTAMP",
    "DimPromotion": f"PromotionKey {KEY}, PromotionAK {KEY}, PromotionName STRING, DiscountPercentage {STORED}, "
    "PromotionType STRING, PromotionCategory STRING, PromotionStartDate TIMESTAMP, PromotionEndDate TIMESTAMP, "
    "MinQuantity INT, MaxQuantity INT",
    "DimSalesTerritory": f"SalesTerritoryKey {KEY}, SalesTerritoryAK {KEY}, SalesTerritoryName STRING, "
    "SalesCountryRegionCode STRING, SalesCountryRegionName STRING",
    "DimGeography": f"GeographyKey {KEY}, GeographyAK {KEY}, City STRING, AddressLine1 STRING, AddressLine2 STRING, "
    "StateProvinceCode STRING, StateProvinceName STRING, PostalCode STRING, CountryRegionCode STRING, "
    "CountryRegionName STRING",
    "DimEmployee": f"EmployeeKey {KEY}, EmployeeAK {KEY}, Title STRING, FirstName STRING, LastName STRING, "
    "MiddleName STRING, Suffix STRING, EmailAddress STRING, JobTitle STRING, CurrentFlag BOOLEAN, "
    "ExpirationDate TIMESTAMP, LoadDate TIMESTAMP",
    "FactSales": f"SalesOrderNumber STRING, SalesOrderLineNumber INT, RevisionNumber INT, ProductKey {KEY}, "
    f"SalesPersonKey {KEY}, CustomerKey {KEY}, BillToAddressKey {KEY}, ShipToAddressKey {KEY}, PromotionKey {KEY}, "
    f"SalesTerritoryKey {KEY}, OrderDateKey INT, DueDateKey INT, ShipDateKey INT, OrderQuantity SMALLINT, "
    f"UnitPrice {STORED}, DiscountAmount FLOAT, ProductStandardCost {STORED}, TotalProductCost {STORED}, "
    f"SalesAmount {STORED}, TaxAmount {STORED}, FreightAmount {STORED}",
    "DimDate": "date_key INT, date_date DATE, year INT, month INT, day INT, week_of_year INT, day_of_week INT",
}

# How the tables that grow with history are partitioned beside the number of the batch.
ORDER_MONTH = "OrderMonth"  # yyyymm, 0 for orders without a date
BATCHED_TABLES = {"FactSales": ORDER_MONTH}
VERSIONED_TABLES = {"DimCustomer", "DimEmployee"}


def schema_of(table: str) -> StructType:
    """Struct type of a source or warehouse table."""
    return StructType.fromDDL(SOURCE_TABLES.get(table) or WAREHOUSE_TABLES[table])
