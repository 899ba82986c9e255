import pytest
from conftest import ALL_LIMITS, rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from starloom.operators import assign_keys, max_key, number_in_groups, ordered_index


def test_index_equals_global_row_number(spark):
    # Enough rows for several range partitions, in no order, with gaps.
    df = spark.range(200_000).select((F.xxhash64("id") % 10**12).alias("ak")).distinct().repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ordered_index(df, "ak")
        parts = got.select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = df.withColumn("idx", F.row_number().over(Window.orderBy("ak")) - 1)
    assert parts > 1
    assert got.exceptAll(want.select("ak", F.col("idx").cast("long"))).isEmpty()
    assert got.count() == want.count()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.text(alphabet="abcXYZ é0", min_size=1, max_size=6), min_size=1, max_size=40), st.integers(0, 5))
def test_keys_are_dense_unique_and_above_the_old_maximum(spark, names, old):
    members = spark.createDataFrame([(n,) for n in names], "ak string")
    dest = spark.range(1, old + 1).select(F.col("id").alias("key"))
    keyed = {r["ak"]: r["key"] for r in assign_keys(members, "ak", "key", after=dest).collect()}
    in_order = sorted(names, key=lambda n: n.encode())
    assert keyed == {n: old + 1 + i for i, n in enumerate(in_order)}


def test_max_key_of_an_empty_table_is_zero(spark):
    assert max_key(spark.range(0), "id").first()[0] == 0
    assert max_key(spark.range(5), "id").first()[0] == 4


@ALL_LIMITS
def test_line_numbers_in_groups_of_any_size(spark, limits):
    group = F.expr("case when id % 3 = 0 then 1 when id % 3 = 1 then null else id end")
    lines = spark.range(2000).select(group.alias("g"), (F.xxhash64("id")).alias("line"))
    got = number_in_groups(lines, "g", "line", "n", limits)
    want = lines.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("line")))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("size", [200])
def test_more_lines_than_a_byte_can_count(spark, size):
    lines = spark.range(size).select(F.lit(1).alias("g"), "id")
    assert number_in_groups(lines, "g", "id", "n").agg(F.max("n")).first()[0] == size
