"""Lookups and order lines are not shuffled where a broadcast does."""

import pytest
from conftest import SALTED, rows

from starloom.limits import Limits
from starloom.operators import Lookup, lookup_keys
from starloom.operators.skew import rows_with_ids


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_dimensions_leave_their_part_of_the_limit_to_a_larger_one(spark):
    # 900 rows of 64 bytes fit a limit of 60,000 bytes beside two of 10 rows, but not a third of it.
    large = spark.range(900).selectExpr("id + 1 as LargeKey", "id as LargeAK")
    small = spark.range(10).selectExpr("id + 1 as SmallKey", "id as SmallAK")
    facts = spark.range(2000).selectExpr("id", "id % 1000 as LargeAK", "id % 20 as FirstAK", "id % 30 as SecondAK")
    roles = [
        Lookup(large, "LargeAK", "LargeKey"),
        Lookup(small, "FirstAK", "FirstKey", "SmallKey", "SmallAK"),
        Lookup(small, "SecondAK", "SecondKey", "SmallKey", "SmallAK"),
    ]
    for limit, shuffled in ((60_000, False), (50_000, True)):
        got = lookup_keys(facts, roles, limits=Limits(broadcast_bytes=limit))
        assert ("SortMergeJoin" in plan_of(got)) == shuffled
        want = facts.selectExpr(
            "id", "if(id % 1000 < 900, id % 1000 + 1, null) as LargeKey", "if(id % 20 < 10, id % 20 + 1, null) as FirstKey",
            "if(id % 30 < 10, id % 30 + 1, null) as SecondKey",
        )
        assert rows(got) == rows(want)


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_rows_with_ids_keeps_exactly_the_wanted(spark, kind):
    every = spark.range(-300, 300).selectExpr(f"cast(id as {kind}) as k", "id * 2 as v")
    every = every.unionByName(spark.sql(f"select cast(null as {kind}) as k, 7L as v"))
    far = "9223372036854775807, -9223372036854775808" if kind == "bigint" else "2147483647"
    wanted = spark.sql(f"select explode(array(-300, -65, -64, -63, -1, 0, 63, 64, 64, 250, 5000, null, {far})) as k")
    wanted = wanted.selectExpr(f"cast(k as {kind}) as k")
    got = rows_with_ids(every, wanted, "k", Limits())
    assert rows(got, "k", "v") == [(k, 2 * k) for k in (-300, -65, -64, -63, -1, 0, 63, 64, 250)]
    assert "Exchange hashpartitioning" not in plan_of(got)
    assert rows(rows_with_ids(every, wanted, "k", SALTED)) == rows(every)  # masks that are not small: left to the join
