"""Orders that are known already cost a comparison of their numbers, not of whole headers."""

import pytest
from conftest import rows

from starloom.limits import Limits
from starloom.plans.sales import new_fact_rows, new_headers


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("limit", [-1, 300, 3_000, 1 << 20])
@pytest.mark.parametrize("loaded", [0, 70, 100, 200])
@pytest.mark.parametrize("unnumbered", [False, True])
def test_headers_are_those_that_the_whole_comparison_gives(spark, limit, loaded, unnumbered):
    number = "concat('SO', id % 100) as SalesOrderNumber"
    header = spark.range(150).selectExpr("id", number, "repeat('x', 200) as note")
    if unnumbered:
        header = header.unionByName(spark.sql("select 7L as id, cast(null as string) as SalesOrderNumber, 'y' as note"))
    fact = spark.range(loaded).selectExpr("concat('SO', id % 100) as SalesOrderNumber", "id as line")
    limits = Limits(broadcast_bytes=limit)
    got = new_headers(header, fact, limits=limits)
    assert rows(got, *header.columns) == rows(new_fact_rows(header, fact, limits=limits), *header.columns)
    assert got.count() == sum(i % 100 >= loaded for i in range(150)) + unnumbered


def test_a_repeated_load_does_not_work_out_the_headers(spark):
    totals = spark.range(400).selectExpr("id % 100 as id", "id as amount").groupBy("id").sum("amount")
    header = spark.range(100).join(totals, "id", "left").selectExpr("concat('SO', id) as SalesOrderNumber", "`sum(amount)` as total")
    fact = header.selectExpr("SalesOrderNumber", "1 as line")
    got = new_headers(header, fact, limits=Limits(broadcast_bytes=-1))
    assert got.isEmpty()
    assert "Join" not in plan_of(got) and "Aggregate" not in plan_of(got)
