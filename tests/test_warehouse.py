"""Loads of a whole warehouse from hand-made source files."""

import uuid
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import SALTED, rows
from pyspark.sql import functions as F

from starloom import plans, sources
from starloom.limits import Limits

DAY1, DAY2, DAY3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
SPAN = (date(2023, 12, 1), date(2024, 1, 31))


def table(spark, name, *members):
    """Rows of a source table from dicts; columns not named are NULL."""
    schema = sources.schema_of(name)
    return spark.createDataFrame([tuple(m.get(c) for c in schema.names) for m in members], schema)


def money(text):
    return Decimal(text)


def person(ak, first, changed):
    return {"BusinessEntityID": ak, "FirstName": first, "LastName": "L", "ModifiedDate": changed}


def email(ak, address, changed):
    return {"BusinessEntityID": ak, "EmailAddressID": ak, "EmailAddress": address, "ModifiedDate": changed}


def order(number, customer, **other):
    return {
        "SalesOrderID": number,
        "SalesOrderNumber": f"SO{number}",
        "RevisionNumber": 1,
        "OrderDate": DAY1,
        "DueDate": DAY2,
        "CustomerID": customer,
        "TerritoryID": 1,
        "BillToAddressID": 11,
        "ShipToAddressID": 12,
        "SubTotal": money("100"),
        "TaxAmt": money("8"),
        "Freight": money("4"),
        **other,
    }


def line(number, line_id, product=501, total="50", offer=1):
    return {
        "SalesOrderID": number,
        "SalesOrderDetailID": line_id,
        "OrderQty": 2,
        "ProductID": product,
        "SpecialOfferID": offer,
        "UnitPrice": money("25"),
        "UnitPriceDiscount": money("0.1"),
        "LineTotal": money(total),
    }


def world(spark, **changes):
    data = {
        "SpecialOffer": [{"SpecialOfferID": 1, "Description": "none", "DiscountPct": money("0")}] * 2,
        "Employee": [{"BusinessEntityID": 7, "JobTitle": "Rep", "CurrentFlag": True}],
        "Product": [
            {"ProductID": 501, "Name": "Bike", "StandardCost": money("10.5"), "ProductSubcategoryID": 1,
             "ProductModelID": 2, "SellStartDate": date(2020, 1, 1)},
            {"ProductID": 502, "Name": "Bell", "StandardCost": money("1")},
        ],
        "ProductSubcategory": [{"ProductSubcategoryID": 1, "ProductCategoryID": 9, "Name": "Road"}],
        "ProductCategory": [{"ProductCategoryID": 9, "Name": "Bikes"}],
        "ProductModel": [{"ProductModelID": 2, "Name": "NULL"}],
        "Customer": [{"CustomerID": 100, "PersonID": 1}, {"CustomerID": 200, "PersonID": 2}, {"CustomerID": 300}],
        "Person": [person(1, "Ann", DAY1), person(2, "Bob", DAY3), person(7, "Rep", DAY1)],
        "EmailAddress": [email(1, "ann@x", DAY1), email(7, "rep@x", DAY1)],
        "SalesTerritory": [{"TerritoryID": 1, "Name": "North", "CountryRegionCode": "AA"}],
        "CountryRegion": [{"CountryRegionCode": "AA", "Name": "Aland"}],
        "Address": [
            {"AddressID": 11, "AddressLine1": 'Lane 1, "Yard"', "StateProvinceID": 5},
            {"AddressID": 12, "AddressLine1": "Lane 2", "StateProvinceID": 5},
            {"AddressID": 13, "AddressLine1": "Nowhere", "StateProvinceID": 6},
        ],
        "StateProvince": [{"StateProvinceID": 5, "StateProvinceCode": "S", "CountryRegionCode": "AA", "Name": "State"}],
        "SalesOrderHeader": [order(1, 100, SalesPersonID=7), order(2, 200), order(3, 300, SubTotal=money("0"))],
        "SalesOrderDetail": [line(1, 20), line(1, 10), line(2, 30, 502), line(2, 31, 502), line(3, 40)],
    }
    data.update(changes)
    return {name: table(spark, name, *members) for name, members in data.items()}


@pytest.fixture(params=["default", "salted"])
def warehouse(spark, tmp_path, request):
    limits = {"default": Limits(), "salted": SALTED}[request.param]
    return plans.Warehouse(spark, f"w_{uuid.uuid4().hex}", limits).create(str(tmp_path / "db"))


def test_load_then_change_then_repeat(spark, warehouse):
    w = warehouse
    w.run(world(spark), DAY2, SPAN)
    # Ann was modified before the run, Bob only after it, and 300 is a store without a person.
    assert rows(w.table("DimCustomer"), "CustomerKey", "CustomerAK", "FirstName", "EmailAddress", "Inferred") == [
        (1, 100, "Ann", "ann@x", 0),
        (2, 200, None, None, 1),
        (3, 300, None, None, 1),
    ]
    assert rows(w.table("DimGeography"), "GeographyKey", "AddressLine1", "CountryRegionName") == [
        (1, 'Lane 1, "Yard"', "Aland"),
        (2, "Lane 2", "Aland"),
    ]
    products = w.table("DimProduct")
    assert rows(products, "ProductKey", "ProductSubCategoryName", "ProductCategoryName", "ProductModelName") == [
        (1, "Road", "Bikes", ""),
        (2, None, None, ""),
    ]
    assert w.table("DimPromotion").count() == 1
    assert w.table("DimDate").count() == 62
    facts = rows(
        w.table("FactSales"), "SalesOrderNumber", "SalesOrderLineNumber", "CustomerKey", "SalesPersonKey",
        "ProductKey", "BillToAddressKey", "ShipToAddressKey", "TotalProductCost", "TaxAmount", "ShipDateKey",
    )
    assert facts == [
        ("SO1", 1, 1, 1, 1, 1, 2, money("21.00"), money("4.00"), None),
        ("SO1", 2, 1, 1, 1, 1, 2, money("21.00"), money("4.00"), None),
        ("SO2", 1, 2, None, 2, 1, 2, money("2.00"), money("4.00"), None),
        ("SO2", 2, 2, None, 2, 1, 2, money("2.00"), money("4.00"), None),
        ("SO3", 1, 3, None, 1, 1, 2, money("21.00"), None, None),
    ]

    # Next day: Bob arrives, Ann and the employee have new addresses, SO1 gets a line, SO4 is new.
    later = world(
        spark,
        EmailAddress=[email(1, "ann@y", DAY3), email(2, "bob@x", DAY3), email(7, "rep@y", DAY3)],
        SalesOrderHeader=[order(1, 100), order(4, 100), order(5, 999)],
        SalesOrderDetail=[line(1, 10), line(1, 20), line(1, 21), line(4, 50), line(5, 60)],
    )
    w.run(later, DAY3, SPAN)
    customers = rows(
        w.table("DimCustomer"), "CustomerKey", "CustomerAK", "EmailAddress", "ExpirationDate", "LoadDate", "Inferred"
    )
    assert customers == [
        (1, 100, "ann@x", DAY3, DAY2, 0),
        (2, 200, "bob@x", None, DAY3, 0),
        (3, 300, None, None, DAY2, 1),
        (4, 100, "ann@y", None, DAY3, 0),
        (5, 999, None, None, DAY3, 1),
    ]
    assert rows(w.table("DimEmployee"), "EmployeeKey", "EmailAddress", "ExpirationDate") == [
        (1, "rep@x", DAY3),
        (2, "rep@y", None),
    ]
    new = w.table("FactSales").filter("SalesOrderNumber IN ('SO4', 'SO5')")
    assert rows(new, "SalesOrderNumber", "CustomerKey") == [("SO4", 4), ("SO5", 5)]
    assert w.table("FactSales").count() == 7  # the line added to SO1 is not picked up

    before = {t: rows(w.table(t)) for t in sources.WAREHOUSE_TABLES if t != "FactSales"}
    w.run(later, DAY3, SPAN, fact_key=["SalesOrderNumber", "SalesOrderLineNumber"])
    assert w.table("FactSales").count() == 8  # compared line by line, it is
    assert {t: rows(w.table(t)) for t in before} == before


def test_a_failed_step_does_not_move_the_watermark(spark, tmp_path):
    w = plans.Warehouse(spark, f"w_{uuid.uuid4().hex}").create(str(tmp_path / "db"))
    broken = world(spark)
    broken["Person"] = broken["Person"].withColumn("Title", F.raise_error(F.lit("gone")))
    with pytest.raises(Exception, match="gone"):
        w.run(broken, DAY2, SPAN)
    assert rows(w.table("DataFlow")) == [("DimCustomer", None)]
    assert w.table("FactSales").isEmpty()
    w.run(world(spark), DAY2, SPAN)
    assert rows(w.table("DataFlow")) == [("DimCustomer", DAY2)]
    assert w.table("FactSales").count() == 5


def test_equal_lines_all_reach_the_fact(spark, tmp_path):
    w = plans.Warehouse(spark, f"w_{uuid.uuid4().hex}").create(str(tmp_path / "db"))
    lines = [line(1, n) for n in range(1, 201)]
    w.run(world(spark, SalesOrderDetail=lines), DAY2, SPAN)
    fact = w.table("FactSales")
    assert fact.count() == 200
    assert fact.drop("SalesOrderLineNumber").distinct().count() == 1
    assert fact.agg({"SalesOrderLineNumber": "max"}).first()[0] == 200


def test_unmatched_keys_may_get_a_number(spark, tmp_path):
    w = plans.Warehouse(spark, f"w_{uuid.uuid4().hex}").create(str(tmp_path / "db"))
    src = world(spark)
    w.load_dimensions(src, DAY2)
    w.load_customers(src, DAY2)
    staged = plans.stage_sales(src["SalesOrderHeader"], src["SalesOrderDetail"], src["Product"])
    w.load_facts(staged, DAY2, unknown_key=-1)
    assert rows(w.table("FactSales").select("SalesPersonKey").distinct()) == [(-1,), (1,)]


def test_lines_without_a_product_take_no_number(spark):
    src = world(spark, SalesOrderDetail=[line(1, 10), line(1, 11, product=999), line(1, 12)])
    for limits in (Limits(), SALTED):
        staged = plans.stage_sales(
            src["SalesOrderHeader"], src["SalesOrderDetail"], src["Product"], few_orders=True, limits=limits
        )
        assert rows(staged, "SalesOrderNumber", "SalesOrderLineNumber") == [("SO1", 1), ("SO1", 2)]


def test_a_product_that_arrives_later_brings_its_line_once(spark, tmp_path):
    key = ["SalesOrderNumber", "SalesOrderLineNumber"]
    w = plans.Warehouse(spark, f"w_{uuid.uuid4().hex}", number_all_lines=True).create(str(tmp_path / "db"))
    src = world(spark, SalesOrderDetail=[line(1, 10), line(1, 11, product=999), line(1, 12)])
    late = table(spark, "Product", {"ProductID": 999, "Name": "Late", "StandardCost": money("1")})
    for products, expected in ((src["Product"], [1, 3]), (src["Product"].unionByName(late), [1, 2, 3])):
        w.load_facts(w.new_lines({**src, "Product": products}, ["SalesOrderDetailID"], key), DAY2, key)
        assert rows(w.table("FactSales"), *key) == [("SO1", n) for n in expected]


def test_numbers_of_all_lines(spark):
    src = world(spark, SalesOrderDetail=[line(1, 10), line(1, 11, product=999), line(1, 12)])
    staged = plans.stage_sales(
        src["SalesOrderHeader"], src["SalesOrderDetail"], src["Product"], limits=SALTED, number_all_lines=True
    )
    assert rows(staged, "SalesOrderNumber", "SalesOrderLineNumber") == [("SO1", 1), ("SO1", 3)]


def test_load_from_files_rebuilds_only_what_changed(spark, tmp_path):
    lake, staging = tmp_path / "lake", tmp_path / "staging"
    files = plans.Files(str(lake), str(staging))

    def export(src):
        for name, df in src.items():
            df.coalesce(1).write.mode("overwrite").option("sep", "\t").csv(str(lake / f"{name}.csv"))

    def newest(name):
        return max(f.stat().st_mtime_ns for f in (staging / name).glob("*.parquet"))

    export(world(spark))
    w = plans.Warehouse(spark, f"w_{uuid.uuid4().hex}", files=files).create(str(tmp_path / "db"))
    w.run(None, DAY2, SPAN)
    assert w.table("FactSales").count() == 5
    assert rows(w.table("DimGeography"), "GeographyKey", "AddressLine1")[0] == (1, 'Lane 1, "Yard"')
    built = {name: newest(name) for name in sources.STAGING_SOURCES}
    before = {t: rows(w.table(t)) for t in sources.WAREHOUSE_TABLES if t != "DataFlow"}

    # The customers of the next window were in the files all along; only their set is built again.
    w.run(None, DAY3, SPAN)
    assert {name for name in built if newest(name) != built[name]} == {"customer"}
    assert {t: rows(w.table(t)) for t in before if t != "DimCustomer"} == {t: v for t, v in before.items() if t != "DimCustomer"}
    bob = w.table("DimCustomer").filter("CustomerAK = 200 and Inferred = 0").collect()  # modified on day 3
    assert len(bob) == 1
    built["customer"] = newest("customer")

    changed = world(spark, SalesOrderHeader=[order(1, 100), order(9, 100)], SalesOrderDetail=[line(9, 90)])
    export({t: changed[t] for t in ("SalesOrderHeader", "SalesOrderDetail")})
    w.run(None, DAY3, SPAN)
    assert {name for name in built if newest(name) != built[name]} == {"sales", "customer"}
    assert w.table("FactSales").count() == 6


def test_repeated_members_are_decided_or_rejected(spark, tmp_path):
    staged = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (None, "x", 1), (None, "y", 1)], "PromotionAK int, PromotionName string, Seen int")
    w = plans.Warehouse(spark, f"w_{uuid.uuid4().hex}", latest={"DimPromotion": ["Seen"]}).create(str(tmp_path / "db"))
    w.merge("DimPromotion", staged, "PromotionAK", "PromotionKey")
    assert rows(w.table("DimPromotion"), "PromotionAK", "PromotionName") == [(1, "new")]
    strict = plans.Warehouse(spark, w.database, reject=True)
    with pytest.raises(ValueError, match="more than one row"):
        strict.merge("DimPromotion", staged, "PromotionAK", "PromotionKey")
    strict.merge("DimPromotion", staged.filter("Seen = 1"), "PromotionAK", "PromotionKey")  # rows without a key name no member
    assert w.table("DimPromotion").count() == 1


def test_an_optional_source_may_be_absent(spark, tmp_path):
    for name, df in world(spark).items():
        if name != "SpecialOffer":
            df.coalesce(1).write.option("sep", "\t").csv(str(tmp_path / "lake" / f"{name}.csv"))
    database, lake, staging = f"w_{uuid.uuid4().hex}", str(tmp_path / "lake"), str(tmp_path / "staging")
    w = plans.Warehouse(spark, database, files=plans.Files(lake, staging, optional=["SpecialOffer"])).create(str(tmp_path / "db"))
    w.run(None, DAY2, SPAN)
    assert w.table("FactSales").count() == 5
    assert w.table("DimPromotion").isEmpty()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        plans.Warehouse(spark, database, files=plans.Files(lake, staging)).sources()
