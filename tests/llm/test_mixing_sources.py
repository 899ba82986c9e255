"""Mixing with many sources, with plans too large to be broadcast, and with columns named like its own."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from starloom.limits import Limits
from starloom.llm import mixing


@pytest.mark.parametrize("fan", [10, 128])
def test_groups_of_sources_are_dealt_exactly(spark, fan):
    want = {f"s{i}": i * i % 23 for i in range(60)}
    dealt = mixing.deal(spark.createDataFrame(list(want.items()), "_key string, quota long"), 9, fan=fan).collect()
    got, rooms = Counter(), Counter()
    for r in dealt:
        got[r["_key"]] += r["n"]
        rooms[r["shard"]] += r["n"]
    assert len(dealt) == len({(r["_key"], r["shard"]) for r in dealt}) and all(r["n"] > 0 for r in dealt)
    assert got == Counter({k: n for k, n in want.items() if n})
    whole = sum(want.values())
    assert [rooms[i] for i in range(9)] == [whole * (i + 1) // 9 - whole * i // 9 for i in range(9)]


def test_groups_do_not_bias_the_draws(spark):
    quotas = spark.createDataFrame([(f"s{i}", 40) for i in range(40)], "_key string, quota long")
    counts = [r["n"] for r in mixing.deal(quotas, 4, fan=10).collect()]
    assert sum(counts) == 1600 and len(counts) == 160  # 10 on average
    variance = 40 * 0.25 * 0.75 * 1560 / 1599
    assert 0.7 * variance < sum((n - 10) ** 2 for n in counts) / 160 < 1.4 * variance


def test_twenty_thousand_sources(spark):
    rows = spark.range(40_000).select(
        F.concat(F.lit("s"), F.col("id") % 20_000).alias("_key"),
        (F.col("id") % 7 + 1).alias("_size"),
        (F.xxhash64("id").bitwiseAND((1 << 60) - 1)).alias("_place"),
        F.col("id").alias("doc_id"),
    )
    plan = mixing.plan_mix(rows, shard_words=25_000)
    assert plan.count() == 20_000 and plan.select(F.max("shards")).first()[0] > 4
    # The leaves own exactly the quota of every source.
    owned = F.coalesce(F.element_at(F.filter("shard_ends", lambda e: e > 0), -1), F.lit(0))
    assert plan.filter(owned != F.col("quota")).isEmpty()
    drawn = mixing.draw(rows, plan)
    taken = drawn.agg(F.sum(F.size("_draws") * F.col("_size")), F.max(F.size("_draws"))).first()
    total = plan.agg(F.sum("words")).first()[0]
    assert abs(taken[0] - total) < 0.05 * total and taken[1] <= 3


def test_plans_for_large_tables_give_the_same_draws(docs):
    large = Limits(broadcast_bytes=-1, hot_share=0.05, sketch_items=1024, window_rows=0)
    placed = mixing.with_places(docs)
    got = []
    for limits in (Limits(), large):
        plan = mixing.plan_mix(placed, block_words=50, shard_words=1000, limits=limits)
        drawn = mixing.draw(placed, plan, limits=limits)
        got.append(sorted((str(r["doc_id"]), r["_size"], r["_target"], [tuple(d) for d in r["_draws"]]) for r in drawn.collect()))
    assert got[0] == got[1]


def test_shards_are_found_by_bisection(spark):
    ends = [3, 4, 9, 9, 20]
    found = spark.range(25).select("id", mixing._passed(F.lit(ends).cast("array<long>"), F.col("id"), len(ends)).alias("n")).collect()
    assert all(r["n"] == sum(e <= r["id"] for e in ends) for r in found)


def test_columns_named_like_its_own_are_kept(docs):
    wide = docs.withColumns({"_draw": F.lit(1), "_document": F.lit("d"), "_size": F.lit(-5)})
    mixed = mixing.mix(wide, shard_words=1000)
    assert mixed.columns == wide.columns
    said = {tuple(r) for r in wide.select("doc_id", "text", "_key", "_draw", "_document", "_size").collect()}
    assert {tuple(r) for r in mixed.select("doc_id", "text", "_key", "_draw", "_document", "_size").collect()} <= said
