"""Blocks of surrogate keys: loads that start together share no key."""

from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

from conftest import rows
from test_warehouse import DAY1, SPAN, world

from starloom import operators as ops, plans, sinks


def test_blocks_of_loads_that_start_together_are_disjoint(spark, tmp_path):
    start = Barrier(8)

    def take(i):
        log = sinks.KeyLog(spark, str(tmp_path / "log a"))
        start.wait()
        return [(log.reserve("customer", n, lambda: 100), n) for n in range(1 + i, 6 + i)]

    with ThreadPoolExecutor(8) as pool:
        blocks = sorted(b for got in pool.map(take, range(8)) for b in got)
    at = 100
    for first, n in blocks:
        assert first == at
        at += n
    log = sinks.KeyLog(spark, str(tmp_path / "log a"))
    assert log.mark("customer") == at and log.mark("product") is None
    assert log.reserve("customer", 0) == at and log.mark("customer") == at


def test_the_loser_of_a_race_takes_the_next_block(spark, tmp_path, monkeypatch):
    log, other = (sinks.KeyLog(spark, f"file://{tmp_path}/log") for _ in range(2))
    put, raced = log._put, []

    def late(name, move, mark):
        if not raced:
            raced.append(other.reserve(name, 5))  # another load moves the mark between our reading and our move
        return put(name, move, mark)

    monkeypatch.setattr(log, "_put", late)
    assert log.reserve("k", 3) == 5 and raced == [0] and log.mark("k") == 8


def test_keys_go_on_after_those_in_use(spark, tmp_path):
    log = sinks.KeyLog(spark, str(tmp_path / "log"))
    dim = spark.createDataFrame([(7, "a"), (9, "b")], "k long, ak string")
    staged = spark.createDataFrame([("b",), ("c",), ("d",), ("c",)], "ak string")
    one = ops.insert_new(staged, dim, "ak", "k", reserve=log.block("d"))
    assert rows(one) == [(10, "c"), (11, "d")]
    # A load that read the dimension before the first one stored its members; the first may also have died.
    two = ops.insert_new(spark.createDataFrame([("e",)], "ak string"), dim, "ak", "k", reserve=log.block("d"))
    assert rows(two) == [(12, "e")]
    assert rows(ops.insert_new(staged.limit(0), dim, "ak", "k", reserve=log.block("d"))) == [] and log.mark("d") == 12


def test_a_warehouse_with_a_key_log(spark, tmp_path):
    log = sinks.KeyLog(spark, str(tmp_path / "log"))
    warehouse = plans.Warehouse(spark, "keylog", key_log=log).create(str(tmp_path / "db"))
    warehouse.run(world(spark), DAY1, calendar=SPAN)
    customers = [k for (k,) in rows(warehouse.table("DimCustomer"), "CustomerKey")]
    assert customers == list(range(1, len(customers) + 1))
    assert log.mark("DimCustomer") == len(customers)
