"""Batched tables: repeatable appends, pruned comparison of facts, history written partition by partition."""

import uuid
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_warehouse import DAY1, DAY2, DAY3, SPAN, email, line, order, world

from starloom import plans, sinks
from starloom.plans import sales
from starloom.scratch import scratch_folder, scratch_path
from starloom.sinks import batches

NOW = datetime(2024, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def table(spark, tmp_path):
    database = f"b_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {database} LOCATION '{tmp_path / 'db'}'")
    sinks.create_batched(spark, f"{database}.t", "id BIGINT, note STRING", "month", "INT")
    return f"{database}.t"


def frame(spark, *members):
    return spark.createDataFrame(members, "id long, note string, month int")


def test_batches_are_seen_when_committed(spark, table):
    assert sinks.last_batch(spark, table) == 0 and sinks.committed(spark, table).isEmpty()
    sinks.append_batch(frame(spark, (1, "a", 1), (2, "b", 2)), table, NOW)
    sinks.write_batch(frame(spark, (3, "c", 1), (4, "d", 3)), table, 2)  # and then the load died
    assert rows(sinks.committed(spark, table), "id") == [(1,), (2,)]
    # The next load has other rows; nothing of the first try stays, in no partition.
    sinks.append_batch(frame(spark, (3, "c", 1), (5, "e", None)), table, NOW)
    assert rows(sinks.committed(spark, table), "id", "month", "LoadBatch") == [(1, 1, 1), (2, 2, 1), (3, 1, 2), (5, None, 2)]
    sinks.append_batch(frame(spark).limit(0), table, NOW)
    assert sinks.last_batch(spark, table) == 3 and sinks.committed(spark, table).count() == 4


def test_a_killed_append_leaves_each_line_once(spark, table):
    good = spark.range(1000).select("id", F.lit("x").alias("note"), (F.col("id") % 5).cast("int").alias("month"))
    dies = F.when(F.col("id") == 999, F.raise_error(F.lit("killed"))).otherwise(F.col("note"))
    with pytest.raises(Exception, match="killed"):
        sinks.append_batch(good.withColumn("note", dies), table, NOW)
    # Some files of the dying append may have been moved in place before it died.
    sinks.write_batch(good.filter("id < 300"), table, 1)
    assert sinks.committed(spark, table).isEmpty()
    sinks.append_batch(good, table, NOW)
    assert sinks.committed(spark, table).count() == 1000
    assert sinks.committed(spark, table).select("id").distinct().count() == 1000


def test_clearing_needs_static_overwrite(spark, table):
    sinks.write_batch(frame(spark, (1, "a", 1)), table, 1)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        with pytest.raises(RuntimeError, match="must be static"):
            sinks.write_batch(frame(spark, (1, "a", 1)), table, 1)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")


def test_a_load_that_died_while_writing_facts_is_repeated(spark, tmp_path):
    w = plans.Warehouse(spark, f"w_{uuid.uuid4().hex}").create(str(tmp_path / "db"))
    w.run(world(spark, SalesOrderHeader=[order(1, 100)], SalesOrderDetail=[line(1, 10)]), DAY2, SPAN)
    # The second load stored one of two lines of order 2 and died before it committed the batch.
    part = w.table("FactSales").withColumns({"SalesOrderNumber": F.lit("SO2"), "OrderMonth": F.lit(202401)})
    batches.write_batch(part, w.name("FactSales"), 2)
    assert w.table("FactSales").count() == 1
    src = world(spark, SalesOrderHeader=[order(1, 100), order(2, 200)], SalesOrderDetail=[line(1, 10), line(2, 30), line(2, 31)])
    w.run(src, DAY2, SPAN)
    keys = ["SalesOrderNumber", "SalesOrderLineNumber"]
    assert rows(w.table("FactSales"), *keys) == [("SO1", 1), ("SO2", 1), ("SO2", 2)]


def test_only_the_months_of_incoming_orders_are_read(spark, tmp_path):
    w = plans.Warehouse(spark, f"w_{uuid.uuid4().hex}").create(str(tmp_path / "db"))
    dates = [datetime(2023, m, 5) for m in range(1, 13)] + [None]
    headers = [order(n, 100, OrderDate=d) for n, d in enumerate(dates, 1)]
    w.run(world(spark, SalesOrderHeader=headers, SalesOrderDetail=[line(n, n) for n in range(1, 14)]), DAY2, SPAN)
    assert w.table("FactSales").count() == 13
    later = world(spark, SalesOrderHeader=[order(3, 100, OrderDate=dates[2]), order(20, 100, OrderDate=dates[3])])
    facts = w.facts_of(later["SalesOrderHeader"], plans.sales.calendar_key(F.col("OrderDate")))
    keys = facts.select("SalesOrderNumber")
    assert "PartitionFilters" in plan_of(keys)
    pruned = plan_of(keys).split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "OrderMonth" in pruned and "LoadBatch" in pruned
    assert "ReadSchema: struct<SalesOrderNumber:string>" in plan_of(keys)
    assert rows(keys) == [("SO3",), ("SO4",)]
    # The second load itself plans its anti-join over those partitions.
    new = sales.new_fact_rows(later["SalesOrderHeader"], facts, limits=w.limits)
    assert "OrderMonth" in plan_of(new) and rows(new, "SalesOrderNumber") == [("SO20",)]
    w.run(world(spark, SalesOrderHeader=[order(13, 100, OrderDate=None), order(21, 100)], SalesOrderDetail=[line(13, 13), line(21, 1)]), DAY2, SPAN)
    assert w.table("FactSales").count() == 14
    moving = plans.Warehouse(spark, w.database, moving_dates=True)
    assert moving.facts_of(later["SalesOrderHeader"], F.lit(0)).count() == 14
    assert w.facts_of(later["SalesOrderHeader"].limit(0), F.lit(20230101)).count() == 1  # the one without a date


def partitions(tmp_path, table, kind):
    found = (tmp_path / "db" / table.lower()).glob(f"LoadBatch=*/VersionKind={kind}/*.parquet")
    return {f.parent.parent.name: f.stat().st_mtime_ns for f in found}


def test_a_change_writes_the_current_versions_only(spark, tmp_path):
    w = plans.Warehouse(spark, f"w_{uuid.uuid4().hex}", keep=2).create(str(tmp_path / "db"))
    for day, address in ((DAY1, "a"), (DAY2, "b"), (DAY3, "c"), (datetime(2024, 1, 4), "d")):
        closed = partitions(tmp_path, "DimEmployee", "closed")
        mail = [email(1, "ann@x", DAY1), email(7, f"{address}@x", day)]
        w.load_dimensions(world(spark, EmailAddress=mail), day)
        now = partitions(tmp_path, "DimEmployee", "closed")
        assert {k: v for k, v in now.items() if k in closed} == closed  # no closed version was written again
        assert len(now) == len(closed) + (address != "a")
        assert len(partitions(tmp_path, "DimEmployee", "current")) <= 2  # ``keep``
    got = rows(w.table("DimEmployee"), "EmployeeKey", "EmailAddress", "ExpirationDate")
    assert got == [(1, "a@x", DAY2), (2, "b@x", DAY3), (3, "c@x", datetime(2024, 1, 4)), (4, "d@x", None)]
    assert rows(w.current("DimEmployee"), "EmployeeKey") == [(4,)]
    assert "closed" not in plan_of(w.current("DimEmployee")).split("PartitionFilters")[1]
    before = partitions(tmp_path, "DimEmployee", "current")
    w.load_dimensions(world(spark, EmailAddress=[email(7, "d@x", day)]), day)
    assert partitions(tmp_path, "DimEmployee", "current") == before  # nothing changed, nothing was written


def test_history_whose_commit_was_lost_is_written_anew(spark, tmp_path):
    w = plans.Warehouse(spark, f"w_{uuid.uuid4().hex}").create(str(tmp_path / "db"))
    w.load_dimensions(world(spark, EmailAddress=[email(7, "a@x", DAY1)]), DAY1)
    stray = w.table("DimEmployee").withColumns({"VersionKind": F.lit("closed"), "ExpirationDate": F.lit(DAY2)})
    batches.write_batch(stray, w.name("DimEmployee"), 1)
    assert rows(w.table("DimEmployee"), "EmployeeKey", "ExpirationDate") == [(1, None)]
    w.load_dimensions(world(spark, EmailAddress=[email(7, "b@x", DAY3)]), DAY3)
    assert rows(w.table("DimEmployee"), "EmployeeKey", "EmailAddress", "ExpirationDate") == [(1, "a@x", DAY3), (2, "b@x", None)]


def test_rewrites_keep_some_folders(spark, tmp_path):
    name = f"d_{uuid.uuid4().hex}"
    sinks.create_tables(spark, name, {"t": "id LONG"}, str(tmp_path / "db"))
    for n in range(5):
        sinks.rewrite_table(spark.range(n + 1), f"{name}.t", keep=2)
    assert spark.table(f"{name}.t").count() == 5
    assert len(list((tmp_path / "db").glob("t__v_*"))) == 2


def test_intermediate_tables_go_with_the_run(spark, tmp_path):
    with scratch_folder(spark, "outer"):
        path = scratch_path(spark, "x")
        spark.range(3).write.parquet(path)
        with scratch_folder(spark, "inner"):
            assert scratch_path(spark, "y").rsplit("/", 1)[0] == path.rsplit("/", 1)[0]
        assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert scratch_path(spark, "x").rsplit("/", 1)[0] != path.rsplit("/", 1)[0]
