from datetime import datetime

import pytest
from conftest import BOTH_LIMITS, rows
from pyspark.sql import functions as F

from starloom.operators import (
    Lookup,
    apply_history,
    changed_members,
    conform,
    except_distinct,
    member_changes,
    inferred_members,
    insert_new,
    lookup_key,
    lookup_keys,
    missing_members,
    one_per_key,
    resolve_inferred,
    rows_not_in,
)

T0, T1, T2 = datetime(2020, 1, 1), datetime(2021, 1, 1), datetime(2022, 1, 1)
DIM = "k long, ak int, mail string, name string, ExpirationDate timestamp, LoadDate timestamp, Inferred tinyint"
STG = "ak int, mail string, name string"


def dim(spark, *members):
    return spark.createDataFrame(list(members), DIM)


# -- new members ----------------------------------------------------------------


@BOTH_LIMITS
def test_only_unknown_members_get_keys(spark, limits):
    dest = dim(spark, (4, 10, "a", "A", None, T0, 0), (9, 30, "c", "C", None, T0, 0))
    staging = spark.createDataFrame([(40, "d", "D"), (10, "x", "X"), (20, "b", "B")], STG)
    got = insert_new(staging, dest, "ak", "k", limits=limits)
    assert got.schema.names == dest.schema.names
    assert rows(got, "k", "ak", "mail") == [(10, 20, "b"), (11, 40, "d")]
    assert insert_new(staging, dest.unionByName(got), "ak", "k", limits=limits).isEmpty()


def test_repeated_members_get_one_key(spark):
    staging = spark.createDataFrame([(1, "a", "older"), (1, "b", "newer"), (2, "c", "C"), (None, "d", "D")], STG)
    got = insert_new(staging, dim(spark), "ak", "k", latest="mail")
    assert rows(got, "k", "ak", "name") == [(1, 1, "newer"), (2, 2, "C")]


def test_one_per_key(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 5, "y"), (1, 4, "z"), (2, None, None)], "a int, b int, c string")
    assert rows(one_per_key(df, "a", "b")) == [(1, 5, "y"), (2, None, None)]
    assert rows(one_per_key(df.select("a"), "a")) == [(1,), (2,)]
    with pytest.raises(ValueError):
        one_per_key(df, "a", reject=True)
    assert one_per_key(df, ["a", "b", "c"], reject=True) is df


def test_conform_binds_by_name_in_any_case(spark):
    target = spark.createDataFrame([], "Key long, Inferred tinyint, note string")
    got = conform(spark.createDataFrame([(1, 7)], "inferred int, KEY int"), target)
    assert got.schema.simpleString() == "struct<Key:bigint,Inferred:tinyint,note:string>"
    assert rows(got) == [(7, 1, None)]
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        conform(spark.createDataFrame([(300, 7)], "inferred int, key int"), target).collect()


@BOTH_LIMITS
def test_new_orders_and_new_lines(spark, limits):
    staged = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1), ("B", 1)], "o string, l int")
    fact = spark.createDataFrame([("A", 1)], "o string, l int")
    assert rows(rows_not_in(staged, fact, "o", limits)) == [("B", 1), ("B", 1)]  # both copies stay
    assert rows(rows_not_in(staged, fact, ["o", "l"], limits), "o", "l") == [("A", 2), ("B", 1), ("B", 1)]


def test_except_distinct(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "b"), (2, "b"), (3, "c")], "a int, b string")
    right = spark.createDataFrame([(2, "b"), (9, "z"), (3, None)], "a int, b string")
    assert rows(except_distinct(left, right)) == [(1, None), (3, "c")]
    plan = except_distinct(left, right)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate") == 1  # one shuffle, of combined rows


# -- history ----------------------------------------------------------------------


@BOTH_LIMITS
def test_three_changes_keep_every_version(spark, limits):
    dest = dim(
        spark,
        (1, 10, "first", "A", T0, T0, 0),
        (2, 10, "second", "A", None, T0, 0),
        (3, 20, "same", "B", None, T0, 0),
    )
    staging = spark.createDataFrame([(10, "third", "A2"), (20, "same", "renamed"), (30, "new", "C")], STG)
    got = apply_history(dest, staging, "ak", "k", "mail", T1, inferred="Inferred", limits=limits)
    assert rows(got, "k", "ak", "mail", "name", "ExpirationDate", "LoadDate") == [
        (1, 10, "first", "A", T0, T0),
        (2, 10, "second", "A", T1, T0),
        (3, 20, "same", "B", None, T0),
        (4, 10, "third", "A2", None, T1),
    ]
    again = apply_history(got, staging, "ak", "k", "mail", T2, inferred="Inferred", limits=limits)
    assert rows(again) == rows(got)
    assert not member_changes(dest, staging, "ak", "k", "mail", inferred="Inferred", limits=limits).isEmpty()
    assert member_changes(got, staging, "ak", "k", "mail", inferred="Inferred", limits=limits).isEmpty()


def test_changes_from_and_to_null(spark):
    dest = dim(spark, (1, 10, None, "A", None, T0, 0), (2, 20, "b", "B", None, T0, 0), (3, 30, None, "C", None, T0, 0))
    staging = spark.createDataFrame([(10, "a", "A"), (20, None, "B"), (30, None, "C")], STG)
    changes = changed_members(dest, staging, "ak", "k", "mail", inferred="Inferred")
    assert rows(changes) == [(1, 10, None, "a"), (2, 20, "b", None)]
    got = apply_history(dest, staging, "ak", "k", "mail", T1)
    current = got.filter("ExpirationDate IS NULL")
    assert rows(current, "k", "ak", "mail") == [(3, 30, None), (4, 10, "a"), (5, 20, None)]


def test_one_current_version_although_old_ones_differ_too(spark):
    dest = dim(spark, (1, 10, "x", "A", T0, T0, 0), (2, 10, "y", "A", T0, T0, 0), (3, 10, "z", "A", None, T0, 0))
    staging = spark.createDataFrame([(10, "new", "A"), (10, "new", "A")], STG)
    got = apply_history(dest, staging, "ak", "k", "mail", T1)
    assert got.filter("ExpirationDate IS NULL").count() == 1
    assert got.count() == 4


@BOTH_LIMITS
def test_inferred_member_is_completed_in_place_and_not_versioned(spark, limits):
    dest = dim(spark, (1, 10, None, None, None, T0, 1), (2, 20, None, None, None, T0, 1))
    staging = spark.createDataFrame([(10, "a", "A")], STG)
    got = apply_history(dest, staging, "ak", "k", "mail", T1, inferred="Inferred", limits=limits)
    assert rows(got, "k", "ak", "mail", "name", "Inferred") == [(1, 10, "a", "A", 0), (2, 20, None, None, 1)]
    assert rows(resolve_inferred(dest, staging, "ak", "k", limits=limits)) == rows(got)


# -- lookups and inferred members ---------------------------------------------------


@BOTH_LIMITS
def test_unknown_customer_gets_one_key_for_all_its_lines(spark, limits):
    dest = dim(spark, (5, 10, "a", "A", None, T0, 0))
    facts = spark.createDataFrame([(1, 77), (1, 77), (2, 77), (3, 10), (4, 66), (5, None)], "o int, ak int")
    assert rows(missing_members(facts, dest, "ak", limits)) == [(66,), (77,)]
    new = inferred_members(facts, dest, "ak", "k", T1, limits=limits)
    assert rows(new, "k", "ak", "mail", "name", "LoadDate", "Inferred") == [
        (6, 66, None, None, T1, 1),
        (7, 77, None, None, T1, 1),
    ]
    keyed = lookup_key(facts, dest.unionByName(new), "k", "ak", limits=limits)
    assert rows(keyed, "o", "k") == [(1, 7), (1, 7), (2, 7), (3, 5), (4, 6), (5, None)]


@BOTH_LIMITS
def test_lookup_neither_multiplies_nor_loses_facts(spark, limits):
    dest = dim(spark, (1, 10, "x", "A", T0, T0, 0), (2, 10, "y", "A", None, T1, 0), (3, 20, "z", "B", None, T1, 0))
    facts = spark.range(600).select(F.expr("case when id % 3 = 0 then 10 else id % 40 end").cast("int").alias("ak"))
    keyed = lookup_key(facts, dest, "k", "ak", limits=limits)
    assert keyed.columns == ["k"]
    known = {10: 2, 20: 3}
    want = sorted(known.get(r["ak"], -1) for r in facts.collect())
    assert sorted(r["k"] for r in lookup_key(facts, dest, "k", "ak", unknown_key=-1, limits=limits).collect()) == want
    assert keyed.filter("k IS NULL").count() == want.count(-1)


@BOTH_LIMITS
def test_one_dimension_in_two_roles(spark, limits):
    places = spark.createDataFrame([(100, 1), (200, 2)], "GeographyKey long, GeographyAK int")
    facts = spark.createDataFrame([(1, 1, 2), (2, 2, 9), (3, None, 1)], "o int, bill int, ship int")
    roles = [
        Lookup(places, "bill", "BillKey", "GeographyKey", "GeographyAK"),
        Lookup(places, "ship", "ShipKey", "GeographyKey", "GeographyAK"),
    ]
    got = lookup_keys(facts, roles, limits=limits)
    assert rows(got) == [(1, 100, 200), (2, 200, None), (3, None, 100)]
