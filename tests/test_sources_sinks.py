import os
import time
import uuid
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starloom import plans, sinks, sources
from starloom.operators import read_watermark, seed_watermark, upsert_watermark
from starloom.scratch import scratch_path


@pytest.fixture
def database(spark, tmp_path):
    return f"t_{uuid.uuid4().hex}", str(tmp_path / "db")


def test_declared_schemas_are_complete():
    assert len(sources.SOURCE_TABLES) == 15 and len(sources.WAREHOUSE_TABLES) == 9
    named = {t for tables in sources.STAGING_SOURCES.values() for t in tables}
    assert named == set(sources.SOURCE_TABLES)


@pytest.mark.parametrize(
    ("table", "width"),
    [("SpecialOffer", 11), ("Employee", 16), ("Product", 25), ("Person", 13), ("SalesOrderHeader", 26),
     ("SalesOrderDetail", 11), ("DimCustomer", 11), ("DimProduct", 17), ("FactSales", 21), ("DimDate", 7)],
)
def test_schema_widths(spark, table, width):
    assert len(sources.schema_of(table)) == width


def test_scan_binds_by_position_and_bad_cells_are_null(spark, tmp_path):
    (tmp_path / "t.csv").write_text("1\tone\t2020-01-02\t1.25\t1\nx\ttwo, \"2\"\tnever\tmuch\tfalse\n\tthree\t\t\t\n")
    got = sources.scan_delimited(
        spark, str(tmp_path / "t.csv"), "i INT, s STRING, d DATE, m DECIMAL(19,4), flag BOOLEAN", quote=""
    )
    assert [tuple(r) for r in got.collect()] == [
        (1, "one", date(2020, 1, 2), Decimal("1.25"), True),
        (None, 'two, "2"', None, None, False),
        (None, "three", None, None, None),
    ]


def test_ids_written_as_floats_stay_exact(spark, tmp_path):
    line = "16777217\t16777217.0\t\t5\tAW1\tguid\t2014-09-12\n"
    (tmp_path / "Customer.csv").write_text(line)
    got = sources.scan_source(spark, str(tmp_path), "Customer")
    assert got.schema == sources.schema_of("Customer")
    assert tuple(got.first())[:4] == (16777217, 16777217, None, 5)


def test_absent_source_is_empty(spark, tmp_path):
    assert sources.scan_source(spark, str(tmp_path), "Customer", optional=True).collect() == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sources.scan_source(spark, str(tmp_path), "Customer")


def test_freshness(spark, tmp_path):
    source, staged = tmp_path / "source", tmp_path / "staged"
    sinks.write_staging(spark.range(1), str(source))
    sets = {"a": (str(staged), [str(source), str(tmp_path / "absent")])}
    rebuild = lambda tag="": sources.changed_sources(spark, sets, tag).first()["rebuild"]
    assert rebuild()
    now = sources.manifest(spark, sets["a"][1])
    sinks.write_staging(spark.range(1), str(staged))
    assert rebuild()  # stored, but not marked: the build may have died
    sources.mark_built(str(staged), now)
    assert not rebuild() and rebuild("another window")
    later = time.time() + 60
    for file in source.glob("*.parquet"):
        os.utime(file, (later, later))
    assert rebuild()


def test_checked_scan_splits_off_what_does_not_fit(spark, tmp_path):
    lines = ["1\tone\t1.5\t1", "x\ttwo\t2.5\t0", "3\tthree", "4\tfour\t4.5\ttrue\tmore", "8\t\t\t", "6\tsix\tmuch\t0", "7\tseven\t7\tperhaps"]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    good, bad = sources.scan_checked(spark, str(tmp_path / "t.csv"), "i INT, s STRING, m DECIMAL(5,2), flag BOOLEAN")
    assert rows(good) == [(1, "one", Decimal("1.50"), True), (8, None, None, None)]
    assert {r["record"]: r["reason"] for r in bad.collect()} == {
        lines[1]: "mistyped", lines[2]: "short", lines[3]: "long", lines[5]: "mistyped", lines[6]: "mistyped",
    }
    assert all(r["path"].endswith("t.csv") for r in bad.collect())
    (tmp_path / "c.csv").write_text("1\t776.0\n2\tabc\n3\t\n")
    good, bad = sources.scan_checked(spark, str(tmp_path / "c.csv"), "i INT, p INT", float_ids=["p"])
    assert rows(good) == [(1, 776), (3, None)] and bad.count() == 1
    (tmp_path / "e.csv").write_text("")
    assert [f.count() for f in sources.scan_checked(spark, str(tmp_path / "e.csv"), "i INT, p INT")] == [0, 0]


def test_landing_reads_only_files_that_changed(spark, tmp_path):
    folder, landed = tmp_path / "in", str(tmp_path / "landed")
    folder.mkdir()
    for n in range(6):
        (folder / f"{n}.csv").write_text(f"{n}\tfirst\n{n + 10}\tfirst\n")
    read = []

    def scan(paths):
        read.append(sorted(p.rsplit("/", 1)[1] for p in paths))
        return sources.scan_delimited(spark, paths, "id INT, note STRING")

    one, two, three = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
    got, changes = sources.land(spark, [str(folder)], landed, scan, one)
    assert got.count() == 12 and rows(changes.groupBy("change").count()) == [("added", 6)]
    (folder / "2.csv").write_text("2\tsecond, and longer\n")
    (folder / "4.csv").unlink()
    (folder / "9.csv").write_text("9\tnew\n")
    # A run that died before it wrote its list left rows of the changed file; they do not count twice.
    scan([str(folder / "2.csv")]).selectExpr("*", "timestamp'2024-01-02' _landed_at", "xxhash64(_metadata.file_path, _metadata.file_modification_time, _metadata.file_size) _version").write.mode("append").partitionBy("_version").parquet(landed)
    read.clear()
    got, changes = sources.land(spark, [str(folder)], landed, scan, two)
    assert read[0] == ["2.csv", "9.csv"]
    assert {r["path"].rsplit("/", 1)[1]: r["change"] for r in changes.collect()} == {"2.csv": "changed", "4.csv": "removed", "9.csv": "added"}
    assert rows(got.filter(F.col("_landed_at") == two), "id", "note") == [(2, "second, and longer"), (9, "new")]
    assert got.filter(F.col("_landed_at") == one).count() == 8
    read.clear()
    got, changes = sources.land(spark, [str(folder)], landed, scan, three)
    assert not any(read) and changes.isEmpty() and got.count() == 10
    for file in folder.glob("*.csv"):
        file.unlink()
    got, changes = sources.land(spark, [str(folder), str(tmp_path / "absent")], landed, scan, three)
    assert got.count() == 0 and rows(changes.groupBy("change").count()) == [("removed", 6)]


def test_calendar(spark):
    days = sources.calendar_days(spark, "1999-12-31", "2025-01-02")
    assert days.count() == 9135
    assert tuple(days.filter("date_key = 20000102").first()) == (20000102, date(2000, 1, 2), 2000, 1, 2, 52, 1)
    for wrong in ("2024/01/01", "yesterday"):
        with pytest.raises(ValueError):
            sources.calendar_days(spark, wrong, "2025-01-02")


def test_calendar_load_appends_what_is_missing(spark, database):
    name, where = database
    sinks.create_tables(spark, name, {"DimDate": sources.WAREHOUSE_TABLES["DimDate"]}, where)
    table = f"{name}.DimDate"
    assert plans.load_calendar(table, "2024-01-10", "2024-01-20", spark)
    assert not plans.load_calendar(table, "2024-01-12", "2024-01-18", spark)
    assert plans.load_calendar(table, "2024-01-01", "2024-01-31", spark)
    got = spark.table(table)
    assert got.count() == got.distinct().count() == 31


def test_tables_are_created_once_and_bind_by_name(spark, database):
    name, where = database
    for _ in range(2):
        sinks.create_tables(spark, name, {"t": "Id LONG, Note STRING, Flag TINYINT"}, where)
        sinks.append_table(spark.createDataFrame([("it's, \"quoted\"\n", 1)], "note string, id int"), f"{name}.t")
    assert rows(spark.table(f"{name}.t")) == [(1, 'it\'s, "quoted"\n', None)] * 2
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        sinks.append_table(spark.createDataFrame([(300,)], "flag int"), f"{name}.t")
    assert sinks.describe_table(spark, f"{name}.t").filter("col_name = 'Provider'").first()["data_type"] == "parquet"


def test_rewriting_a_table_from_itself_again_and_again(spark, database):
    name, where = database
    sinks.create_tables(spark, name, {"t": "id LONG"}, where)
    sinks.append_table(spark.range(3), f"{name}.t")
    for _ in range(3):
        sinks.rewrite_table(spark.table(f"{name}.t").select((F.col("id") + 10).alias("id")), f"{name}.t")
    sinks.append_table(spark.range(1), f"{name}.t")
    assert rows(spark.table(f"{name}.t")) == [(0,), (30,), (31,), (32,)]


def test_a_failed_rewrite_leaves_the_table_alone(spark, database):
    name, where = database
    sinks.create_tables(spark, name, {"t": "id LONG"}, where)
    sinks.append_table(spark.range(3), f"{name}.t")
    with pytest.raises(Exception, match="no good"):
        sinks.rewrite_table(spark.table(f"{name}.t").select(F.raise_error(F.lit("no good")).alias("id")), f"{name}.t")
    assert rows(spark.table(f"{name}.t")) == [(0,), (1,), (2,)]


def test_control_rows(spark):
    control = spark.createDataFrame([], "DataFlowName string, LastSuccessfulModifiedDate timestamp")
    now = datetime(2024, 2, 1, 12, 30)
    control = control.unionByName(seed_watermark(control, "c"))
    assert seed_watermark(control, "c").isEmpty()
    assert tuple(read_watermark(control, "c", now).first()) == ("c", datetime(1900, 1, 1), "2024-02-01 12:30:00")
    control = upsert_watermark(upsert_watermark(control, "c", now), "d", datetime(2024, 1, 1))
    assert control.schema["LastSuccessfulModifiedDate"].dataType.simpleString() == "timestamp"
    assert rows(control) == [("c", now), ("d", datetime(2024, 1, 1))]
    twice = control.unionByName(spark.createDataFrame([("c", None)], control.schema))
    assert read_watermark(twice, "c", now).first()[1] == now
    with pytest.raises(ValueError):
        upsert_watermark(control, "c", None)


def test_scratch_is_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    if root:
        assert path.startswith(root)
