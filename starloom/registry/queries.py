"""Every operator as a query over the test tables: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import operators as ops, plans, sinks, sources
from ..functions import blank_tokens, calendar_key
from ..limits import DEFAULT
from ..scratch import materialize, scratch_path, shuffles_removed
from .retail import LINE_ORDER, ORDERS_LOADED_UNTIL, Retail, ntz

WINDOW = (datetime(2024, 1, 28), datetime(2024, 1, 30))
RUN = datetime(2024, 2, 1)
EARLY_RUN = datetime(2024, 1, 20)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Retail(spark, folder))
    return build


def _fresh_database(spark: SparkSession) -> tuple[str, str]:
    name = f"starloom_{uuid.uuid4().hex}"
    return name, scratch_path(spark, name)


# -- scans and sinks -----------------------------------------------------------


@query
def scan_tsv(r: Retail) -> DataFrame:
    """Customers written as headerless tab-separated text and read back by position."""
    path = scratch_path(r.spark, "tsv")
    r.table("customer").write.option("sep", "\t").csv(path)
    return sources.scan_delimited(
        r.spark, path, "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    )


@query
def scan_parquet(r: Retail) -> DataFrame:
    path = f"{r.folder}/lineitem.parquet"
    return sources.scan_parquet(r.spark, path).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


@query
def sink_roundtrip(r: Retail) -> DataFrame:
    return sinks.write_staging(r.table("orders"), scratch_path(r.spark, "orders"))


@query
def sink_append(r: Retail) -> DataFrame:
    """Two appends with columns in different order and case; the table binds them by name."""
    database, where = _fresh_database(r.spark)
    sinks.create_tables(r.spark, database, {"accounts": "ak BIGINT, name STRING, segment STRING"}, where)
    rows = r.table("customer").select(
        F.col("c_mktsegment").alias("SEGMENT"), F.col("c_name").alias("Name"), F.col("c_custkey").alias("ak"), "c_acctbal"
    )
    for part in (F.col("c_acctbal") < 0, F.coalesce(F.col("c_acctbal") >= 0, F.lit(True))):
        sinks.append_table(rows.filter(part), f"{database}.accounts")
    return r.spark.table(f"{database}.accounts")


@query
def sink_rewrite(r: Retail) -> DataFrame:
    """A table replaced by rows that are computed from itself."""
    database, where = _fresh_database(r.spark)
    name = f"{database}.accounts"
    sinks.create_tables(r.spark, database, {"accounts": "ak BIGINT, segment STRING"}, where)
    customers = r.table("customer")
    sinks.append_table(customers.select(F.col("c_custkey").alias("ak"), F.col("c_mktsegment").alias("segment")), name)
    sinks.rewrite_table(r.spark.table(name).withColumn("segment", F.lower("segment")), name)
    return r.spark.table(name)


@query
def scan_rejects(r: Retail) -> DataFrame:
    """Customers as text with records that are cut off, too long or mistyped: what fits, and why the rest does not."""
    c = {n: F.coalesce(F.col(n).cast("string"), F.lit("")) for n in ("c_custkey", "c_name", "c_nationkey")}
    balance = F.when(F.col("c_acctbal") < 0, "owing").otherwise(F.round("c_acctbal").cast("long").cast("string"))
    whole = F.concat_ws("\t", c["c_custkey"], c["c_name"], c["c_nationkey"], balance)
    record = (
        F.when(F.col("c_nationkey") == 3, F.concat_ws("\t", c["c_custkey"], c["c_name"]))
        .when(F.col("c_nationkey") == 5, F.concat_ws("\t", whole, F.lit("more")))
        .otherwise(whole)
    )
    path = scratch_path(r.spark, "records")
    r.table("customer").select(record.alias("value")).write.text(path)
    good, bad = sources.scan_checked(r.spark, path, "c_custkey BIGINT, c_name STRING, c_nationkey INT, balance BIGINT")
    kept = good.select("c_custkey", "balance", F.lit("kept").alias("outcome"))
    key = F.split("record", "\t")[0].cast("long")
    return kept.unionByName(bad.select(key.alias("c_custkey"), F.lit(None).cast("long").alias("balance"), F.col("reason").alias("outcome")))


@query
def describe_table(r: Retail) -> DataFrame:
    """Columns, types, format and number of rows of a table that holds the orders."""
    database, where = _fresh_database(r.spark)
    name, orders = f"{database}.placed", r.table("orders")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in orders.schema)
    sinks.create_tables(r.spark, database, {"placed": columns}, where)
    sinks.append_table(orders, name)
    r.spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    told = sinks.describe_table(r.spark, name).filter(F.col("col_name").isin(*orders.columns, "Provider", "Statistics"))
    rows = F.regexp_extract("data_type", r"(\d+) rows", 1)
    return told.select("col_name", F.when(F.col("col_name") == "Statistics", rows).otherwise(F.lower("data_type")).alias("data_type"))


@query
def changed_sources(r: Retail) -> DataFrame:
    """A staging set built from the files that are there serves again; one that was never built is built.

    Per set: what the gate said, and the rows that the set then holds.
    """
    paths = {t: scratch_path(r.spark, t) for t in ("customer", "orders")}
    files = {t: [f"{r.folder}/{t}.parquet"] for t in paths}
    now = sources.manifest(r.spark, files["customer"])
    sinks.write_staging(r.table("customer"), paths["customer"])
    sources.mark_built(paths["customer"], now)
    said = sources.changed_sources(r.spark, {t: (paths[t], files[t]) for t in paths})
    sets = []
    for row in said.select("staging", "rebuild").collect():  # one row per set
        path = paths[row["staging"]]
        held = sinks.write_staging(r.table(row["staging"]), path) if row["rebuild"] else sources.scan_parquet(r.spark, path)
        sets.append(held.agg(F.lit(row["staging"]).alias("staging"), F.lit(row["rebuild"]).alias("rebuild"), F.count(F.lit(1)).alias("n_rows")))
    return sets[0].unionByName(sets[1])


@query
def landed_files(r: Retail) -> DataFrame:
    """Orders exported to a folder per priority and landed; then one folder is exported anew and one is gone.

    Per order: its price and the run that read it.  The second run reads the folder that changed and no other.
    """
    folder, landed = scratch_path(r.spark, "exports"), scratch_path(r.spark, "landed")
    orders = r.table("orders").select("o_orderkey", (F.round(F.col("o_totalprice") * 100)).cast("long").alias("cents"), "o_orderpriority")
    level = F.substring("o_orderpriority", 1, 1)

    def export(rows: DataFrame, mode: str) -> None:
        place = rows.select("o_orderkey", "cents", level.alias("level")).write.mode("overwrite").option("partitionOverwriteMode", mode)
        place.option("sep", "\t").partitionBy("level").csv(folder)

    def scan(paths: list[str]) -> DataFrame:
        return sources.scan_delimited(r.spark, paths, "o_orderkey BIGINT, cents BIGINT", recursiveFileLookup="true")

    export(orders, "static")
    sources.land(r.spark, [folder], landed, scan, EARLY_RUN)
    export(orders.filter(level == "1").withColumn("cents", F.col("cents") + 1), "dynamic")
    rows, _ = sources.land(r.spark, [f"{folder}/level={n}" for n in (1, 2, 3, 4)], landed, scan, RUN)
    return rows.select("o_orderkey", "cents", F.when(F.col("_landed_at") == F.lit(RUN), 2).otherwise(1).alias("run"))


@query
def sink_batches(r: Retail) -> DataFrame:
    """Order lines appended in two batches by month; the first try of the second died after it had stored some lines."""
    database, where = _fresh_database(r.spark)
    r.spark.sql(f"CREATE SCHEMA {database} LOCATION '{where}'")
    table = f"{database}.lines"
    sinks.create_batched(r.spark, table, "l_orderkey BIGINT, l_linenumber BIGINT, l_partkey BIGINT", "month", "INT")
    month = (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("month")
    lines = r.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", month)
    early = F.col("month") < 199701
    sinks.append_batch(lines.filter(early), table, EARLY_RUN)
    sinks.write_batch(lines.filter(F.col("l_linenumber") < 3), table, 2)  # never committed
    sinks.append_batch(lines.filter(~early), table, RUN)
    return sinks.committed(r.spark, table).withColumnRenamed("LoadBatch", "batch")


# -- dimensions ------------------------------------------------------------------


@query
def dim_geography(r: Retail) -> DataFrame:
    return plans.geography_dimension(r.address(), r.state_province(), r.country_region()).drop("GeographyKey")


@query
def dim_territory(r: Retail) -> DataFrame:
    return plans.territory_dimension(r.sales_territory(), r.country_region()).drop("SalesTerritoryKey")


@query
def dim_product(r: Retail) -> DataFrame:
    dimension = plans.product_dimension(
        r.product(), r.product_subcategory(), r.product_category(), r.product_model()
    )
    return dimension.drop("ProductKey", "SellStartDate", "SellEndDate")


@query
def dim_promotion(r: Retail) -> DataFrame:
    return plans.promotion_dimension(r.special_offer()).select(
        "PromotionAK", "PromotionName", "DiscountPercentage", "PromotionType"
    )


@query
def dim_employee(r: Retail) -> DataFrame:
    dimension = plans.employee_dimension(r.employee(), r.person(), r.email_address(), ntz(RUN))
    return dimension.drop("EmployeeKey", "ExpirationDate")


def _customers(r: Retail, strict: bool) -> DataFrame:
    low, high = map(ntz, WINDOW)
    dimension = plans.customer_dimension(
        r.customer(), r.person(), r.email_address(), low, high, ntz(RUN), strict
    )
    return dimension.withColumn("Inferred", F.col("Inferred").cast("int")).drop("CustomerKey", "ExpirationDate")


@query
def dim_customer_window(r: Retail) -> DataFrame:
    return _customers(r, strict=False)


@query
def dim_customer_window_strict(r: Retail) -> DataFrame:
    return _customers(r, strict=True)


@query
def null_token_clean(r: Retail) -> DataFrame:
    segment = F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
    rows = r.table("customer").select("c_custkey", segment.alias("segment"))
    return blank_tokens(rows, {"segment": ["FURNITURE", "MACHINERY"]})


# -- calendar ----------------------------------------------------------------------


def _span(r: Retail) -> tuple:
    """First and last day on which an order was placed."""
    day = F.to_date("o_orderdate")
    return tuple(r.table("orders").agg(F.min(day), F.max(day)).first())


@query
def dim_date(r: Retail) -> DataFrame:
    return sources.calendar_days(r.spark, *_span(r))


@query
def dim_date_append(r: Retail) -> DataFrame:
    """Days missing from a calendar that so far holds the days with urgent orders."""
    calendar = sources.calendar_days(r.spark, *_span(r))
    urgent = r.table("orders").filter("o_orderpriority = '1-URGENT'")
    loaded = calendar.join(urgent.select(F.to_date("o_orderdate").alias("date_date")), "date_date", "left_semi")
    return plans.missing_days(calendar, loaded)


@query
def calendar_gap(r: Retail) -> DataFrame:
    days = r.table("orders").filter("o_orderpriority = '1-URGENT'").select(F.to_date("o_orderdate").alias("day"))
    gap = plans.calendar_gap(days, *_span(r), column="day")
    return gap.select(F.col("expected_days").cast("long"), "present_days")


# -- order lines ---------------------------------------------------------------------


@query
def stg_sales(r: Retail) -> DataFrame:
    return plans.stage_sales(r.sales_order_header(), r.sales_order_detail(), r.product(), LINE_ORDER)


@query
def line_numbers_in_large_groups(r: Retail) -> DataFrame:
    """Numbers inside three groups that hold a third of all lines each."""
    lines = r.table("lineitem").select("l_returnflag", "l_orderkey", *LINE_ORDER)
    every_group_is_large = replace(DEFAULT, window_rows=0)
    return ops.number_in_groups(lines, "l_returnflag", ["l_orderkey", *LINE_ORDER], "n", every_group_is_large)


# -- keys and new members ------------------------------------------------------------


@query
def max_key(r: Retail) -> DataFrame:
    """The largest key of a table, and of an empty one."""
    customers = r.table("customer")
    nobody = customers.filter("c_mktsegment = 'NOBODY'")
    return ops.max_key(customers, "c_custkey").withColumn(
        "empty_max", ops.max_key(nobody, "c_custkey").scalar()
    )


@query
def footer_bounds(r: Retail) -> DataFrame:
    """Rows and smallest and largest key of the large tables, taken from file footers."""
    keys = {"orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey", "l_partkey"]}
    found = [sources.known_bounds(r.spark, f"{r.folder}/{t}.parquet", cs) for t, cs in keys.items()]
    shaped = [
        df.select(F.lit(t).alias("table_name"), "n_rows", *[F.col(f"{n}_{c}").alias(f"{n}_{i}") for i, c in enumerate(keys[t]) for n in ("min", "max")])
        for t, df in zip(keys, found)
    ]
    return shaped[0].unionByName(shaped[1])


@query
def insert_new_keys(r: Retail) -> DataFrame:
    staging = r.table("customer").select(F.col("c_custkey").alias("CustomerAK"))
    return ops.insert_new(staging, r.known_customers(), "CustomerAK", "CustomerKey")


@query
def insert_new_text_keys(r: Retail) -> DataFrame:
    """Members known by a text; each is staged once per order."""
    customers = r.table("customer").select(F.col("c_custkey").alias("CustomerAK"), "c_name")
    orders = r.table("orders").select(F.col("o_custkey").alias("CustomerAK"))
    known = r.known_customers().join(customers, "CustomerAK").select(
        "CustomerKey", F.col("c_name").alias("NameAK")
    )
    staging = orders.join(customers, "CustomerAK").select(F.col("c_name").alias("NameAK"))
    return ops.insert_new(staging, known, "NameAK", "CustomerKey")


@query
def insert_new_together(r: Retail) -> DataFrame:
    """Customers of two sources, told apart by nation, inserted into an empty dimension by two loads that start together.

    Each load reserves its block of keys, so the two share none, and each numbers its own customers densely.
    """
    log = sinks.KeyLog(r.spark, scratch_path(r.spark, "key-log"))
    staged = r.table("customer").select(F.col("c_custkey").alias("CustomerAK"), "c_nationkey")
    dest = r.spark.createDataFrame([], "CustomerKey long, CustomerAK long")

    def load(source: int) -> DataFrame:
        mine = staged.filter((F.col("c_nationkey") < 12) == F.lit(source == 0))
        new = ops.insert_new(mine, dest, "CustomerAK", "CustomerKey", reserve=log.block("customer"))
        return materialize(new.withColumn("source", F.lit(source)), "keyed")

    with ThreadPoolExecutor(2) as pool:
        first, second = [job.result() for job in [pool.submit(inheritable_thread_target(r.spark)(load), i) for i in (0, 1)]]
    both = first.unionByName(second)
    least, greatest = F.min("CustomerKey"), F.max("CustomerKey")
    loads = both.groupBy("source").agg(F.count(F.lit(1)).alias("n"), least.alias("lo"), greatest.alias("hi"))
    dense = loads.agg(F.count_if(F.col("hi") - F.col("lo") + 1 == F.col("n")).alias("dense_loads"))
    keys = both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("CustomerKey").alias("n_keys"), least.alias("least"), greatest.alias("greatest")
    )
    return keys.withColumn("dense_loads", dense.scalar())


@query
def load_stats(r: Retail) -> DataFrame:
    staging = r.table("orders").select(F.col("o_custkey").alias("CustomerAK"))
    return ops.load_stats(staging, r.known_customers(), "CustomerAK")


@query
def profile_distinct(r: Retail) -> DataFrame:
    return ops.distinct_values(r.table("part"), "p_brand")


@query
def preview_limit(r: Retail) -> DataFrame:
    return ops.preview(r.table("part").select("p_partkey", "p_name"), "p_partkey", 10)


@query
def except_distinct(r: Retail) -> DataFrame:
    flags = r.table("lineitem").select("l_returnflag", "l_linestatus")
    return ops.except_distinct(flags, flags.filter("l_returnflag = 'R'"))


@query
def anti_new_rows(r: Retail) -> DataFrame:
    """Lines of orders of which no line has been loaded."""
    lines = r.table("lineitem").select("l_orderkey", *LINE_ORDER)
    return ops.rows_not_in(lines, r.loaded_lines(), "l_orderkey")


@query
def anti_new_lines(r: Retail) -> DataFrame:
    """Lines whose own number has not been loaded, whatever became of their order."""
    lines = r.table("lineitem").select("l_orderkey", *LINE_ORDER)
    return ops.rows_not_in(lines, r.loaded_lines(), ["l_orderkey", "l_linenumber"])


@query
def anti_new_months(r: Retail) -> DataFrame:
    """Orders placed since July 1997 that are not in the fact table, which is read for their months only."""
    database, where = _fresh_database(r.spark)
    r.spark.sql(f"CREATE SCHEMA {database} LOCATION '{where}'")
    table = f"{database}.facts"
    sinks.create_batched(r.spark, table, "o_orderkey BIGINT, o_custkey BIGINT", sources.ORDER_MONTH, "INT")
    orders = r.table("orders").withColumn("day", calendar_key(F.col("o_orderdate")))
    loaded = orders.filter(F.col("o_orderdate") < ntz(ORDERS_LOADED_UNTIL))
    sinks.append_batch(loaded.withColumn(sources.ORDER_MONTH, plans.order_month(F.col("day"))), table, EARLY_RUN)
    incoming = orders.filter("day >= 19970701").select("o_orderkey", "o_custkey", "day")
    facts = plans.within_months(sinks.committed(r.spark, table), incoming, F.col("day"))
    return ops.rows_not_in(incoming, facts, "o_orderkey")


# -- lookups and inferred members ------------------------------------------------------


def _product_lines(r: Retail) -> DataFrame:
    return r.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_partkey").alias("ProductAK"))


@query
def lookup_key(r: Retail) -> DataFrame:
    return ops.lookup_key(_product_lines(r), r.known_products(), "ProductKey", "ProductAK")


@query
def lookup_unknown_key(r: Retail) -> DataFrame:
    return ops.lookup_key(_product_lines(r), r.known_products(), "ProductKey", "ProductAK", unknown_key=-1)


@query
def lookup_mixed_type_keys(r: Retail) -> DataFrame:
    """Keys of other types than the dimension's: zero-padded texts match the number, fractions match nothing."""
    half = F.when(F.col("l_linenumber") % 2 == 1, 0.5).otherwise(0.0)
    lines = r.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.lpad(F.col("l_partkey").cast("string"), 12, "0").alias("ProductAK"),
        (F.col("l_suppkey").cast("double") + half).alias("CustomerAK"),
    )
    roles = [
        ops.Lookup(r.known_products(), "ProductAK", "ProductKey"),
        ops.Lookup(r.known_customers(), "CustomerAK", "CustomerKey"),
    ]
    return ops.lookup_keys(lines, roles)


@query
def lookup_missing(r: Retail) -> DataFrame:
    return ops.missing_members(_product_lines(r), r.known_products(), "ProductAK")


@query
def lookup_current_version(r: Retail) -> DataFrame:
    """Only current versions of a dimension with history are looked up, so no order is multiplied."""
    orders = r.table("orders").select("o_orderkey", F.col("o_custkey").alias("ak"))
    return ops.lookup_keys(orders, [ops.Lookup(r.status_history(), "ak", "status_key", "k")], expiry="expired")


@query
def lookup_role_playing(r: Retail) -> DataFrame:
    """Buyer and supplier of an order line, both looked up among the known customers."""
    lines = r.order_lines().select(
        "o_orderkey", "l_linenumber", "l_partkey", F.col("o_custkey").alias("BillToAK"), F.col("l_suppkey").alias("ShipToAK")
    )
    dim = r.known_customers()
    roles = [
        ops.Lookup(dim, "BillToAK", "BillToKey", "CustomerKey", "CustomerAK"),
        ops.Lookup(dim, "ShipToAK", "ShipToKey", "CustomerKey", "CustomerAK"),
    ]
    return ops.lookup_keys(lines, roles)


@query
def lookup_bucketed(r: Retail) -> DataFrame:
    """As ``lookup_role_playing``, with the customers in a bucketed table that takes part without broadcast or shuffle."""
    database, where = _fresh_database(r.spark)
    r.spark.sql(f"CREATE SCHEMA {database} LOCATION '{where}'")
    buckets = int(r.spark.conf.get("spark.sql.shuffle.partitions"))
    dim = sinks.write_bucketed(r.known_customers(), f"{database}.customers", "CustomerAK", buckets)
    lines = r.order_lines().select(
        "o_orderkey", "l_linenumber", "l_partkey", F.col("o_custkey").alias("BillToAK"), F.col("l_suppkey").alias("ShipToAK")
    )
    roles = [ops.Lookup(dim, f"{role}AK", f"{role}Key", "CustomerKey", "CustomerAK", bucketed=True) for role in ("BillTo", "ShipTo")]
    return ops.lookup_keys(lines, roles)


def _customer_dim(r: Retail) -> DataFrame:
    names = r.table("customer").select(F.col("c_custkey").alias("CustomerAK"), F.col("c_name").alias("Name"))
    known = r.known_customers().join(names, "CustomerAK").select("CustomerKey", "CustomerAK", "Name")
    return known.withColumns({"LoadDate": ntz(EARLY_RUN), "Inferred": F.lit(0)})


def _customer_orders(r: Retail) -> DataFrame:
    return r.table("orders").select("o_orderkey", F.col("o_custkey").alias("CustomerAK"))


@query
def inferred_members(r: Retail) -> DataFrame:
    return ops.inferred_members(_customer_orders(r), _customer_dim(r), "CustomerAK", "CustomerKey", ntz(RUN))


@query
def fact_with_inferred(r: Retail) -> DataFrame:
    """Orders with customer keys after the unknown customers were entered: no key is missing."""
    orders, dim = _customer_orders(r), _customer_dim(r)
    whole = dim.unionByName(ops.inferred_members(orders, dim, "CustomerAK", "CustomerKey", ntz(RUN)))
    return ops.lookup_key(orders, whole, "CustomerKey", "CustomerAK")


@query
def inferred_resolve(r: Retail) -> DataFrame:
    return ops.resolve_inferred(r.waiting_customers(), r.arrived_customers(), "ak", "k", "inferred")


@query
def scd2_changed(r: Retail) -> DataFrame:
    return ops.changed_members(r.status_history(), r.latest_status(), "ak", "k", "status", expiry="expired")


@query
def scd2_apply(r: Retail) -> DataFrame:
    return ops.apply_history(
        r.status_history(), r.latest_status(), "ak", "k", "status", ntz(RUN), expiry="expired", load_date="loaded"
    )


@query
def history_partitions(r: Retail) -> DataFrame:
    """The same change as in ``scd2_apply``, on a table that keeps current and closed versions apart."""
    database, where = _fresh_database(r.spark)
    r.spark.sql(f"CREATE SCHEMA {database} LOCATION '{where}'")
    table = f"{database}.status"
    kind = r.table("orders").schema["o_orderdate"].dataType.simpleString()
    sinks.create_versioned(r.spark, table, f"k BIGINT, ak BIGINT, status STRING, loaded {kind}, expired {kind}")
    sinks.write_versions(r.status_history(), table, "expired", EARLY_RUN)
    current = sinks.current_versions(r.spark, table)
    after = ops.apply_history(
        current, r.latest_status(), "ak", "k", "status", ntz(RUN), expiry="expired", load_date="loaded"
    )
    sinks.write_versions(after, table, "expired", RUN)
    return sinks.versions(r.spark, table)


@query
def fact_load(r: Retail) -> DataFrame:
    """Lines of new orders with customer, product and - in two roles - address keys."""
    lines = r.order_lines().select(
        "l_orderkey",
        "l_linenumber",
        calendar_key(F.col("o_orderdate")).alias("OrderDateKey"),
        F.col("o_custkey").alias("CustomerAK"),
        F.col("l_partkey").alias("ProductAK"),
        F.col("o_custkey").alias("BillToAK"),
        F.col("l_suppkey").alias("ShipToAK"),
        F.col("l_extendedprice").alias("SalesAmount"),
    )
    new = ops.rows_not_in(lines, r.loaded_lines(), "l_orderkey")
    customers = r.known_customers()
    roles = [
        ops.Lookup(customers, "CustomerAK", "CustomerKey"),
        ops.Lookup(r.known_products(), "ProductAK", "ProductKey"),
        ops.Lookup(customers, "BillToAK", "BillToKey", "CustomerKey", "CustomerAK"),
        ops.Lookup(customers, "ShipToAK", "ShipToKey", "CustomerKey", "CustomerAK"),
    ]
    return new.transform(ops.lookup_keys, roles)


# -- control rows ------------------------------------------------------------------


@query
def watermark_read(r: Retail) -> DataFrame:
    """Windows of a flow that ran, one that never succeeded and one that is not there."""
    flows = [ops.read_watermark(r.control(), flow, RUN) for flow in ("click", "error", "absent")]
    return flows[0].unionByName(flows[1]).unionByName(flows[2])


@query
def watermark_zone(r: Retail) -> DataFrame:
    """The window of a flow with the time zone of the session."""
    window = ops.with_zone(ops.read_watermark(r.control(), "click", RUN))
    return window.withColumn("CurrentTimezone", F.regexp_replace("CurrentTimezone", "^Etc/", ""))


@query
def watermark_upsert(r: Retail) -> DataFrame:
    return ops.upsert_watermark(r.control(), "click", RUN)


@query
def watermark_seed(r: Retail) -> DataFrame:
    """Seeding a known flow and, twice, an unknown one leaves one row per flow."""
    control = r.control()
    for flow in ("click", "view_daily", "view_daily"):
        control = control.unionByName(ops.seed_watermark(control, flow))
    return control


# -- whole loads -------------------------------------------------------------------


def load_star(r: Retail, runs: int = 1) -> plans.Warehouse:
    database, where = _fresh_database(r.spark)
    warehouse = plans.Warehouse(r.spark, database).create(where)
    for _ in range(runs):
        warehouse.run(r.sources(), RUN, calendar=_span(r), line_order=LINE_ORDER)
    return warehouse


@query
def star_load(r: Retail) -> DataFrame:
    """The fact table after loading an empty warehouse."""
    return load_star(r).table("FactSales")


@query
def star_reload(r: Retail) -> DataFrame:
    """Rows per table after the same load ran twice: the second run adds nothing."""
    return load_star(r, runs=2).row_counts()


@query
def star_incremental(r: Retail) -> DataFrame:
    """The customer dimension after an early run on older orders and a later run on all of them.

    Members inferred by the first run are completed by the second and keep their keys.
    """
    database, where = _fresh_database(r.spark)
    warehouse = plans.Warehouse(r.spark, database).create(where)
    src = r.sources()
    early = {**src, "SalesOrderHeader": src["SalesOrderHeader"].filter("OrderDate < timestamp_ntz '1996-01-01'")}
    span = _span(r)
    warehouse.run(early, EARLY_RUN, calendar=span, line_order=LINE_ORDER)
    warehouse.run(src, RUN, calendar=span, line_order=LINE_ORDER)
    return warehouse.table("DimCustomer").select(
        "CustomerKey", "CustomerAK", "FirstName", "EmailAddress", F.col("Inferred").cast("int").alias("Inferred")
    )


def _export(r: Retail, folder: str, src: dict[str, DataFrame]) -> None:
    """The source tables as headerless tab-separated files, compressed, in their declared layout; ids the layout has no place for are NULL."""
    for name, rows in src.items():
        have = set(rows.columns)
        cells = [
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in sources.schema_of(name)
        ]
        with shuffles_removed(r.spark):
            rows.select(*cells).write.mode("overwrite").option("sep", "\t").option("compression", "gzip").csv(f"{folder}/{name}.csv")


def _numbered(r: Retail) -> dict[str, DataFrame]:
    """The source tables; order lines have the id by which the layout orders them.

    Lines are numbered as they are stored, before they get the wider types of the layout.
    """
    numbered = ops.number_in_groups(r.table("lineitem"), "l_orderkey", LINE_ORDER, "SalesOrderDetailID")
    return {**r.sources(), "SalesOrderDetail": r.sales_order_detail(numbered, "SalesOrderDetailID")}


@query
def star_from_files(r: Retail) -> DataFrame:
    """``star_incremental`` from exported files: an early run, then newer exports of the orders and a later run.

    The second run builds only the sets again whose files or window changed.
    """
    database, where = _fresh_database(r.spark)
    lake = scratch_path(r.spark, "lake")
    warehouse = plans.Warehouse(r.spark, database, files=plans.Files(lake, f"{lake}-staging")).create(where)
    src, span = _numbered(r), _span(r)
    with shuffles_removed(r.spark):
        orders = materialize(src["SalesOrderHeader"], "orders")  # exported twice
    _export(r, lake, {**src, "SalesOrderHeader": orders.filter("OrderDate < timestamp_ntz '1996-01-01'")})
    warehouse.run(None, EARLY_RUN, calendar=span)
    _export(r, lake, {"SalesOrderHeader": orders})
    warehouse.run(None, RUN, calendar=span)
    return warehouse.table("DimCustomer").select(
        "CustomerKey", "CustomerAK", "FirstName", "EmailAddress", F.col("Inferred").cast("int").alias("Inferred")
    )


@query
def star_optional_source(r: Retail) -> DataFrame:
    """The fact table loaded from files without the file of offers, which is declared optional: facts have no promotion."""
    database, where = _fresh_database(r.spark)
    lake = scratch_path(r.spark, "lake")
    files = plans.Files(lake, f"{lake}-staging", optional=["SpecialOffer"])
    warehouse = plans.Warehouse(r.spark, database, files=files).create(where)
    _export(r, lake, {name: rows for name, rows in _numbered(r).items() if name != "SpecialOffer"})
    warehouse.run(None, RUN, calendar=_span(r))
    return warehouse.table("FactSales")
