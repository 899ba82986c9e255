"""Joins give the same rows whichever plan the limits choose."""

from collections import Counter

import pytest
from conftest import ALL_LIMITS, SALTED
from pyspark.sql import functions as F

from starloom.limits import Limits
from starloom.operators import are_small, hot_keys, is_small, skew_join


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows has key 7, a fifth has none, the rest is spread; half of it are copies."""
    key = F.expr("case when id % 3 = 0 then 7 when id % 5 = 1 then null else id % 200 end").cast("long")
    return spark.range(3000).select(key.alias("k"), (F.col("id") % 50).alias("v"))


@pytest.fixture(scope="module")
def dims(spark):
    return spark.range(150).select(F.col("id").alias("k"), F.concat(F.lit("d"), F.col("id")).alias("name"))


@ALL_LIMITS
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(facts, dims, how, limits):
    want = Counter(map(tuple, facts.join(dims, "k", how).collect()))
    got = skew_join(facts, dims, "k", how, limits)
    assert Counter(map(tuple, got.collect())) == want


@ALL_LIMITS
def test_right_side_with_many_rows_per_key(spark, facts, limits):
    right = spark.range(60).select((F.col("id") % 10).alias("k"), F.col("id").alias("n"))
    want = Counter(map(tuple, facts.join(right, "k", "left").collect()))
    assert Counter(map(tuple, skew_join(facts, right, "k", "left", limits).collect())) == want


@ALL_LIMITS
def test_two_key_columns(facts, limits):
    right = facts.filter("v < 20").select("k", "v").distinct()
    want = Counter(map(tuple, facts.join(right, ["k", "v"], "left_anti").collect()))
    assert Counter(map(tuple, skew_join(facts, right, ["k", "v"], "left_anti", limits).collect())) == want


def test_keys_of_different_types(spark):
    left = spark.createDataFrame([(16777216, "a"), (16777217, "b")], "k int, v string")
    right = spark.createDataFrame([("16777217", 1), ("no number", 2), ("99999999999", 3)], "k string, n int")
    for limits in (Limits(), SALTED):
        got = {(r["k"], r["n"]) for r in skew_join(left, right, "k", "left", limits).collect()}
        assert got == {(16777216, None), (16777217, 1)}


def test_hot_keys_are_found_and_null_is_one(spark, facts):
    limits = Limits(hot_share=0.1, sketch_items=1024)
    expected = {
        r[0]
        for r in spark.createDataFrame([(7,), (None,)], "k long").select(F.xxhash64("k")).collect()
    }
    assert set(hot_keys(facts, "k", limits)) == expected
    assert all(2 <= n <= 4 for n in hot_keys(facts, "k", limits).values())
    assert hot_keys(facts.limit(0), "k", limits) == {}


def test_size_is_measured_not_estimated(spark):
    texts = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert is_small(texts, Limits(broadcast_bytes=20_000))
    assert not is_small(texts, Limits(broadcast_bytes=10_000))
    nested = spark.range(1).select(F.array("id").alias("a"))
    assert are_small([nested, texts.limit(1), nested], Limits()) == [False, True, False]
    assert are_small([nested]) == [False]


def test_a_large_side_is_never_broadcast(facts, dims):
    # Spark would estimate both sides as tiny; the measured size decides.
    plan = skew_join(facts, dims, "k", "left", Limits(broadcast_bytes=-1, hot_share=0.9))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_unknown_join_type(facts, dims):
    with pytest.raises(ValueError):
        skew_join(facts, dims, "k", "outer")


MIXED = [
    ("int", ["776", "777", None], "double", ["776.0", "776.5", "777.0"]),
    ("date", ["2024-01-01", "2024-01-02"], "timestamp", ["2024-01-01 05:00:00", "2024-01-02 00:00:00"]),
    ("string", ["0776", "x", "777"], "int", ["776", "777"]),
    ("double", ["NaN", "1.0", None], "double", ["NaN", "1.0", None]),
]


@ALL_LIMITS
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("case", range(len(MIXED)))
def test_keys_of_different_types_match_as_in_a_plain_join(spark, limits, how, case):
    kind_a, a, kind_b, b = MIXED[case]
    left = spark.createDataFrame([(x, i) for i, x in enumerate(a * 3)], "k string, l int").withColumn("k", F.col("k").try_cast(kind_a))
    right = spark.createDataFrame([(x, i) for i, x in enumerate(b)], "k string, r int").withColumn("k", F.col("k").try_cast(kind_b))
    plain = right.withColumnRenamed("k", "rk")
    key = F.col("k").try_cast("long") if kind_a == "string" else F.col("k")
    want = left.join(plain, key == F.col("rk"), how).drop("rk")
    got = skew_join(left, right, "k", how, limits)
    assert got.columns == want.columns
    assert Counter(map(str, got.collect())) == Counter(map(str, want.collect()))


@ALL_LIMITS
def test_map_columns_and_copies(spark, limits):
    left = spark.range(2000).select(F.lit(1).alias("k"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    right = spark.createDataFrame([(1, "x")], "k int, r string")
    assert skew_join(left, right, "k", "inner", limits).count() == 2000


def test_copies_of_one_row_reach_several_tasks(spark):
    left = spark.range(0, 100_000, 1, 4).select(F.lit(1).alias("k"))
    right = spark.createDataFrame([(1, "x"), (2, "y")], "k int, r string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew_join(left, right, "k", "inner", SALTED)
        tasks = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(tasks) > 1 and sum(t["count"] for t in tasks) == 100_000
