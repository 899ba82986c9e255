"""Dimensions too big for a plain broadcast are broadcast in blocks of ids, so lines are not shuffled once per dimension."""

import uuid
from decimal import Decimal

import pytest
from conftest import SALTED, rows
from pyspark.sql import functions as F
from test_warehouse import DAY2, SPAN, line, order, world

from starloom import plans
from starloom.limits import Limits
from starloom.operators import Lookup, lookup_keys
from starloom.operators.blocks import id_blocks, rows_in, value_blocks, with_values
from starloom.plans import sales

ENDS = "9223372036854775807, -9223372036854775808"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["int", "bigint"])
@pytest.mark.parametrize("value", ["cast(k * 7 as bigint)", "cast(k as bigint) * 1000000000000", "cast(k as decimal(19, 4)) / 3", "cast(k as int)"])
def test_values_are_those_of_a_join(spark, kind, value):
    far = ENDS if kind == "bigint" else "2147483647, -2147483648"
    facts = spark.range(-400, 400).selectExpr(f"cast(id as {kind}) as k", "id as v").unionByName(
        spark.sql(f"select cast(k as {kind}) as k, 7L as v from (select explode(array({far}, null)) as k)")
    )
    dim = spark.range(-300, 300).filter("id % 3 <> 1").selectExpr("id as k").unionByName(
        spark.sql("select explode(array(-64L, 63L, 64L, null)) as k").filter("k is null")
    )
    some = f"if(k % 5 = 0, null, {value if 'decimal' not in value else f'cast({value} as decimal(19, 4))'})"
    dim = dim.unionByName(spark.sql(f"select explode(array({far})) as k")).selectExpr("k", f"if(abs(k / 2) > 1000, null, {some}) as x")
    blocks = value_blocks(dim, "k", "x")
    for how in ("left", "inner"):
        got = with_values(facts, blocks, "k", "x", how)
        want = facts.join(dim.selectExpr("k as kk", "x"), F.col("k") == F.col("kk"), how).select("k", "v", "x")
        assert got.schema["x"].dataType == dim.schema["x"].dataType
        assert rows(got) == rows(want)
        assert "Exchange hashpartitioning" not in plan_of(got).split("BroadcastExchange")[0]
    assert rows(rows_in(facts, blocks, "k")) == rows(facts.join(dim, "k", "left_semi"))


def test_blocks_are_refused(spark):
    dim = spark.range(100).selectExpr("id as k", "id as x", "cast(id as string) as t", "id / 2 as d")
    assert value_blocks(dim, "k", "x", Limits(broadcast_bytes=2 * 96 + 400)).bytes == 2 * 96 + 400
    assert value_blocks(dim, "k", "x", Limits(broadcast_bytes=2 * 96 + 399)) is None
    assert value_blocks(dim, "t", "x") is None and value_blocks(dim, "k", "t") is None and value_blocks(dim, "k", "d") is None
    assert value_blocks(dim.union(dim.limit(1)), "k", "x") is None  # an id comes twice
    assert value_blocks(dim, "k", "x", SALTED) is None and id_blocks(dim, "k", SALTED) is None
    none = value_blocks(dim.limit(0), "k", "x")
    assert rows(with_values(dim.select("k"), none, "k", "x"), "x") == [(None,)] * 100


def test_lookups_of_large_dimensions_do_not_shuffle_facts(spark):
    dim = spark.range(1000).selectExpr("id + 1 as DimKey", "id as DimAK")
    facts = spark.range(2000).selectExpr("id", "id % 1100 as FirstAK", "cast(id % 900 as int) as SecondAK")
    roles = [Lookup(dim, f"{r}AK", f"{r}Key", "DimKey", "DimAK") for r in ("First", "Second")]
    want = [(i, i % 1100 + 1 if i % 1100 < 1000 else -1, i % 900 + 1) for i in range(2000)]
    for fewest, shuffled in ((0, False), (1001, True)):
        got = lookup_keys(facts, roles, unknown_key=-1, limits=Limits(broadcast_bytes=20_000, block_rows=fewest))
        assert ("SortMergeJoin" in plan_of(got)) == shuffled
        assert rows(got, "id", "FirstKey", "SecondKey") == want


def test_lines_are_shuffled_twice_and_costs_come_after(spark):
    data = world(spark)
    costs = sales.cost_blocks(data["SalesOrderDetail"], data["Product"], Limits())
    header, detail, product = data["SalesOrderHeader"], data["SalesOrderDetail"], data["Product"]
    plain = sales.stage_sales(header, detail, product, limits=SALTED)
    for by_month in (False, True):
        got = sales.stage_sales(header, detail, product, limits=Limits(broadcast_bytes=-1), costs=costs, by_month=by_month)
        assert rows(got, *plain.columns) == rows(plain)
        exchanges = [x for x in plan_of(got).splitlines() if "Exchange hashpartitioning" in x]
        assert len(exchanges) == 2 + by_month  # lines and headers by order, lines by month
        assert not any("ProductStandardCost" in x for x in exchanges)
    assert got.columns[-1] == "OrderMonth" and rows(got.select("OrderMonth").distinct()) == [(202401,)]
    assert rows(sales.ordering_customers(header, detail, product, True, Limits(), costs)) == rows(sales.ordering_customers(header, detail, product, True, SALTED))


def test_repeated_products_multiply_lines_as_before(spark):
    products = [{"ProductID": 501, "Name": "Bike", "StandardCost": Decimal(c)} for c in ("10.5", "11")]
    data = world(spark, Product=products)
    assert sales.cost_blocks(data["SalesOrderDetail"], data["Product"], Limits()) is None
    got = sales.stage_sales(data["SalesOrderHeader"], data["SalesOrderDetail"], data["Product"])
    assert got.count() == 6


@pytest.mark.parametrize("files", [False, True])
def test_a_load_with_blocks_gives_the_same_facts(spark, tmp_path, files):
    many = range(1, 121)
    data = world(
        spark,
        Product=[{"ProductID": i, "Name": f"P{i}", "StandardCost": Decimal(i)} for i in many],
        Customer=[{"CustomerID": i, "PersonID": i} for i in many],
        Address=[{"AddressID": i, "AddressLine1": f"Lane {i}", "StateProvinceID": 5} for i in many],
        SalesOrderHeader=[order(i, i % 130, BillToAddressID=i, ShipToAddressID=121 - i, SalesPersonID=7) for i in many],
        SalesOrderDetail=[line(i, 1000 * n + i, (i * n) % 125) for i in many for n in (1, 2, 3)],
    )
    found = []
    for limits in (Limits(broadcast_bytes=5_000, block_rows=100), SALTED):
        lake, stage = str(tmp_path / uuid.uuid4().hex), str(tmp_path / uuid.uuid4().hex)
        w = plans.Warehouse(spark, f"k_{uuid.uuid4().hex}", limits, files=plans.Files(lake, stage) if files else None)
        w.create(str(tmp_path / uuid.uuid4().hex))
        if files:
            for name, df in data.items():
                df.write.option("sep", "\t").csv(f"{lake}/{name}.csv")
        w.run(None if files else data, DAY2, SPAN)
        found.append(rows(w.table("FactSales")))
    assert found[0] == found[1] and len(found[0]) == sum((i * n) % 125 in many for i in many for n in (1, 2, 3))


@pytest.mark.parametrize("limits", [Limits(), SALTED], ids=["default", "salted"])
def test_long_decimals_are_short_in_the_shuffle_and_come_back(spark, limits):
    huge, small = Decimal("999999999999999.9999"), Decimal("-0.0001")
    lines = [{**line(1, 1), "UnitPrice": huge, "LineTotal": small}, {**line(1, 2), "UnitPrice": None}, line(2, 3, total="12345.6789")]
    data = world(spark, SalesOrderHeader=[order(1, 100, Freight=huge), order(2, 200, Freight=None)], SalesOrderDetail=lines)
    header, detail, product = data["SalesOrderHeader"], data["SalesOrderDetail"], data["Product"]
    costs = sales.cost_blocks(detail, product, limits)
    assert (costs is None) == (limits is SALTED)
    got = sales.stage_sales(header, detail, product, limits=limits, costs=costs, by_month=True, amounts=False)
    assert rows(got, "SalesOrderNumber", "SalesOrderLineNumber", "UnitPrice", "SalesAmount", "Freight") == [
        ("SO1", 1, huge, small, huge),
        ("SO1", 2, None, Decimal("50"), huge),
        ("SO2", 1, Decimal("25"), Decimal("12345.6789"), None),
    ]
    assert {c: got.schema[c].dataType.precision for c in ("UnitPrice", "SalesAmount", "Freight")} == dict.fromkeys(("UnitPrice", "SalesAmount", "Freight"), 19)
    shuffled = [x for x in plan_of(got).splitlines() if "Exchange hashpartitioning" in x]
    assert shuffled and "decimal(19" not in "".join(shuffled)


def test_staged_lines_have_the_totals_and_give_the_same_amounts(spark):
    data = world(spark)
    parts = [data[t] for t in ("SalesOrderHeader", "SalesOrderDetail", "Product")]
    whole, stored = sales.stage_sales(*parts), sales.stage_sales(*parts, amounts=False)
    assert "TaxAmount" not in stored.columns and {"SubTotal", "TaxAmt", "Freight"} <= set(stored.columns)
    again = sales.with_amounts(stored)
    assert again.columns == whole.columns and again.schema == whole.schema and rows(again) == rows(whole)


@pytest.mark.parametrize("known", ["id < 100", "id < 250 or id = 399"])
@pytest.mark.parametrize("odd", ["none", "id of a known order", "no id"])
def test_many_new_headers_are_found_by_ids(spark, known, odd):
    header = spark.range(400).selectExpr("id as SalesOrderID", "concat('SO', id) as SalesOrderNumber", "repeat('x', 50) as note")
    if odd != "none":
        header = header.unionByName(spark.sql(f"select {'5L' if odd != 'no id' else 'cast(null as bigint)'} as SalesOrderID, 'SO900' as SalesOrderNumber, 'y' as note"))
    fact = spark.range(400).filter(known).selectExpr("concat('SO', id) as SalesOrderNumber")
    limits = Limits(broadcast_bytes=3_000)
    got = sales.new_headers(header, fact, limits=limits)
    assert rows(got, *header.columns) == rows(sales.new_fact_rows(header, fact, limits=limits), *header.columns)
    assert ("SortMergeJoin" in plan_of(got)) == (odd != "none")


def test_shuffle_files_go_with_their_action(spark, tmp_path):
    from starloom.scratch import _CLEANUP, scratch_folder

    was = spark.conf.get(_CLEANUP, None)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with scratch_folder(spark, "a"):
        with scratch_folder(spark, "b"):
            assert spark.conf.get(_CLEANUP) == "true"
        assert rows(df, "k") == rows(df, "k")  # a frame may be asked twice
        assert len(df.collect()) == len(df.collect()) == 7
    assert spark.conf.get(_CLEANUP, None) == was
