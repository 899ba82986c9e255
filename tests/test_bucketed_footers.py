"""Lookups in bucketed dimensions, and bounds from file footers, by their plans and against plain joins."""

import uuid

import pytest
from conftest import ALL_LIMITS, rows
from pyspark.sql import functions as F
from test_batches import plan_of

from starloom import operators as ops, sinks, sources
from starloom.limits import Limits


@pytest.fixture
def dimension(spark, tmp_path):
    database = f"k_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {database} LOCATION '{tmp_path / 'db'}'")
    members = spark.range(2000).select((F.col("id") * 3).alias("ak"), (F.col("id") + 1).alias("k"))
    return sinks.write_bucketed(members, f"{database}.dim", "ak", 8)


def facts(spark, key="cast(case when id % 3 = 0 then 30 when id % 7 = 0 then null else id % 500 end as bigint)"):
    """A third of all rows have one key, and a seventh of the others none."""
    return spark.range(3000).select("id", F.expr(key).alias("ak"), F.lit("x").alias("note"))


@ALL_LIMITS
def test_bucketed_lookup_equals_a_plain_join(spark, dimension, limits):
    role = ops.Lookup(dimension, "ak", "k", bucketed=True)
    got = ops.lookup_keys(facts(spark), [role], limits=limits)
    want = facts(spark).join(dimension, "ak", "left").select("id", "note", "k")
    assert rows(got, "id", "note", "k") == rows(want)
    assert rows(ops.lookup_keys(facts(spark), [role], unknown_key=-1, limits=limits).filter("k = -1")) == rows(want.filter("k is null").fillna(-1))
    other = ops.lookup_keys(facts(spark, "cast(id % 500 as string)"), [role], limits=limits)  # keys of another type
    assert rows(other, "id", "k") == rows(facts(spark, "id % 500").join(dimension, "ak", "left"), "id", "k")


def test_the_bucketed_side_is_not_shuffled(spark, dimension):
    limits = Limits(broadcast_bytes=-1, hot_share=0.05, sketch_items=1024, window_rows=0)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the first plan is the last
    try:
        staged = facts(spark).withColumn("other", F.col("id") % 700)
        roles = [ops.Lookup(dimension, "ak", "k", bucketed=True), ops.Lookup(dimension, "other", "k2", "k", "ak", bucketed=True)]
        plan = plan_of(ops.lookup_keys(staged, roles, limits=limits))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("SortMergeJoin") == 2
    assert plan.count("Exchange hashpartitioning") == 2  # the facts, once a role
    assert plan.count("Bucketed: true") >= 2


def test_bounds_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10, 5010).select("id", (F.col("id") % 7).cast("int").alias("part"), F.lit(None).cast("long").alias("none")).write.parquet(path)
    found = sources.footer_bounds(spark, path, ["id", "part"])
    plan = plan_of(found)
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id), MIN(part), MAX(part)]" in plan
    assert "ReadSchema: struct<>" in plan or "count(*)" in plan.split("ReadSchema")[1]  # aggregates, not columns
    assert tuple(sources.known_bounds(spark, path, ["id", "part"]).first()) == (5000, 10, 5009, 0, 6)
    assert tuple(sources.known_bounds(spark, path, ["none"]).first()) == (5000, None, None)
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    assert tuple(sources.known_bounds(spark, str(tmp_path / "empty"), ["id"]).first()) == (0, None, None)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
