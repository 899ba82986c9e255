"""The incremental load of the whole star schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import calendar_key
from ..limits import DEFAULT, Limits
from ..operators import control
from ..operators.history import apply_history, member_changes
from ..operators.lookup import inferred_members, lookup_keys, lookup_ways
from ..operators.members import insert_new, one_per_key
from ..operators.numbering import Reserve
from ..operators.skew import as_list
from ..scratch import materialize, scratch_folder
from ..sinks import batches
from ..sinks.keys import KeyLog
from ..sinks.tables import append_table, create_tables, rewrite_table, write_staging
from ..sources.freshness import is_built_from, manifest, mark_built
from ..sources.scans import scan_parquet, scan_source
from ..sources.schemas import BATCHED_TABLES, ORDER_MONTH, SOURCE_TABLES, STAGING_SOURCES, VERSIONED_TABLES, WAREHOUSE_TABLES
from . import dimensions, sales
from .calendar import load_calendar

CUSTOMER_FLOW = "DimCustomer"
ORDER = "SalesOrderNumber"
WHOLE_ORDERS = (ORDER, [ORDER], (ORDER,))

# The days the calendar covers.
CALENDAR = (date(1999, 12, 31), date(2025, 1, 2))


@dataclass(frozen=True)
class Files:
    """Where source files lie and where staging sets are kept between runs."""

    source: str
    staging: str
    suffix: str = ".csv"
    optional: Sequence[str] = ()  # tables whose file may be absent

    def paths(self, tables: Sequence[str]) -> list[str]:
        return [f"{self.source.rstrip('/')}/{t}{self.suffix}" for t in tables]


class Warehouse:
    """Names of the tables of one warehouse, and the steps that load them.

    Every step reads what earlier steps stored, so a run that stopped half-way is simply run
    again.  Facts are partitioned by batch and order month; a batch is seen only when all of it is
    stored.  Dimensions with history keep current and closed versions apart, and a change writes
    the current ones and those it closes (see ``sinks.batches``).

    With ``files``, staging sets are kept, and one is rebuilt only if it is
    missing, its source files are not those it was built from, or it was built for
    another window or key; either way it is then merged.
    """

    def __init__(
        self,
        spark: SparkSession,
        database: str,
        limits: Limits = DEFAULT,
        files: Files | None = None,
        latest: Mapping[str, Sequence[str]] | None = None,
        reject: bool = False,
        number_all_lines: bool = False,
        moving_dates: bool = False,
        keep: int = 2,
        key_log: KeyLog | None = None,
    ):
        """``latest`` names, per dimension table, the staged columns that decide between rows of one
        member; with ``reject`` a member that is staged twice raises instead.  ``number_all_lines`` gives
        lines without a product their numbers too, so a product that arrives later shifts none: to be set
        from the first load on where facts are compared line by line.

        An order keeps its date, so incoming orders are compared with the facts of their own months only;
        ``moving_dates`` compares them with all facts.  ``keep`` is the number of versions of a rewritten table
        that stay, the one in use included.  With a ``key_log`` surrogate keys are reserved before they are used, so
        loads that run at the same time never give one key twice."""
        self.spark, self.database, self.limits, self.files = spark, database, limits, files
        self.latest, self.reject, self.number_all_lines = latest or {}, reject, number_all_lines
        self.moving_dates, self.keep, self.key_log = moving_dates, keep, key_log

    def sources(self) -> dict[str, DataFrame]:
        """The declared source tables as scans of the source folder; absent optional ones are empty."""
        files = self.files
        return {
            t: scan_source(self.spark, files.source, t, files.suffix, optional=t in files.optional) for t in SOURCE_TABLES
        }

    def stage(self, name: str, build: Callable[[], DataFrame], keep: bool = False, tag: str = "") -> DataFrame:
        """The staging set ``name``; without files it is stored only if asked to ``keep`` it for several uses.

        With files, a kept set serves again if it was built from the very same files and with the same ``tag``.
        Its manifest is taken before the sources are read and written after the set, so a file that
        changes in between, or a build that stops, leads to another build.
        """
        if self.files is None:
            return materialize(build(), name) if keep else build()
        path = f"{self.files.staging.rstrip('/')}/{name}"
        now = materialize(manifest(self.spark, self.files.paths(STAGING_SOURCES[name]), tag), "manifest")
        if is_built_from(self.spark, path, now):
            return scan_parquet(self.spark, path)
        staged = write_staging(build(), path)
        mark_built(path, now)
        return staged

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def table(self, table: str) -> DataFrame:
        """The rows of a table that are committed, without the columns it is partitioned by."""
        if table in VERSIONED_TABLES:
            return batches.versions(self.spark, self.name(table))
        if table in BATCHED_TABLES:
            return batches.committed(self.spark, self.name(table)).drop(batches.BATCH, BATCHED_TABLES[table])
        return self.spark.table(self.name(table))

    def current(self, table: str, last: int | None = None) -> DataFrame:
        """The current members of a dimension; closed versions are not read."""
        if table in VERSIONED_TABLES:
            return batches.current_versions(self.spark, self.name(table), last)
        return self.table(table)

    def reserve(self, table: str) -> Reserve | None:
        return self.key_log and self.key_log.block(table)

    def add(self, table: str, members: DataFrame, last: int | None = None) -> None:
        if table in VERSIONED_TABLES:
            batches.add_members(members, self.name(table), last)
        else:
            append_table(members, self.name(table))

    def create(self, location: str | None = None) -> Warehouse:
        plain = {t: c for t, c in WAREHOUSE_TABLES.items() if t not in BATCHED_TABLES and t not in VERSIONED_TABLES}
        create_tables(self.spark, self.database, plain, location)
        for t, month in BATCHED_TABLES.items():
            batches.create_batched(self.spark, self.name(t), WAREHOUSE_TABLES[t], month, "INT")
        for t in VERSIONED_TABLES:
            batches.create_versioned(self.spark, self.name(t), WAREHOUSE_TABLES[t])
        append_table(control.seed_watermark(self.table("DataFlow"), CUSTOMER_FLOW), self.name("DataFlow"))
        return self

    def merge(
        self,
        table: str,
        staging: DataFrame,
        alt_key: str,
        key: str,
        tracked: str | Sequence[str] = (),
        run_ts: datetime | None = None,
        inferred: str | None = None,
    ) -> None:
        """Append new members; with ``tracked``, then rewrite the current versions if known members changed."""
        name, latest = self.name(table), self.latest.get(table, ())
        last = batches.last_batch(self.spark, name) if table in VERSIONED_TABLES else None
        if self.reject:
            one_per_key(staging.filter(F.col(alt_key).isNotNull()), alt_key, reject=True)
        new = insert_new(staging, self.current(table, last), alt_key, key, latest, self.limits, reserve=self.reserve(table))
        self.add(table, new, last)
        if not tracked:
            return
        options = {"inferred": inferred, "latest": latest, "limits": self.limits}
        # Every member has a current version, and the largest key is that of one: closed versions are not needed.
        dest = self.current(table, last)
        changes = member_changes(dest, staging, alt_key, key, tracked, **options)
        if not changes.isEmpty():
            rows = apply_history(dest, staging, alt_key, key, tracked, run_ts, changes=changes, **options)
            batches.write_versions(rows, name, "ExpirationDate", run_ts, self.keep, last)

    def load_dimensions(self, src: Mapping[str, DataFrame], run_ts: datetime) -> None:
        self._together(*self._dimension_loads(src, run_ts))

    def _dimension_loads(self, src: Mapping[str, DataFrame], run_ts: datetime) -> list[Callable[[], object]]:
        """The loads of all dimensions without a modification window; they touch different tables."""
        lim = self.limits

        def parts(name):
            return [src[t] for t in STAGING_SOURCES[name]]

        def promotion():
            staged = self.stage("promotion", lambda: dimensions.promotion_dimension(*parts("promotion")))
            self.merge("DimPromotion", staged, "PromotionAK", "PromotionKey")

        def product():
            staged = self.stage("product", lambda: dimensions.product_dimension(*parts("product"), lim))
            self.merge("DimProduct", staged, "ProductAK", "ProductKey")

        def geography():
            staged = self.stage("geography", lambda: dimensions.geography_dimension(*parts("geography"), lim))
            self.merge("DimGeography", staged, "GeographyAK", "GeographyKey")

        def territory():
            staged = self.stage("territory", lambda: dimensions.territory_dimension(*parts("territory"), lim))
            self.merge("DimSalesTerritory", staged, "SalesTerritoryAK", "SalesTerritoryKey")

        def employee():
            build = lambda: dimensions.employee_dimension(*parts("employee"), run_ts, lim)
            staged = self.stage("employee", build, keep=True)
            self.merge("DimEmployee", staged, "EmployeeAK", "EmployeeKey", "EmailAddress", run_ts)

        return [promotion, product, geography, territory, employee]

    def _together(self, *steps: Callable[[], object]) -> list:
        """Run independent steps at the same time; Spark interleaves their jobs.

        All of them come to an end before the first error, if any, is raised.
        """
        with ThreadPoolExecutor(len(steps)) as pool:
            started = [pool.submit(inheritable_thread_target(self.spark)(step)) for step in steps]
        return [job.result() for job in started]

    def load_customers(self, src: Mapping[str, DataFrame], run_ts: datetime, strict: bool = False) -> None:
        """Customers modified since the last good run; the watermark moves only after they are stored."""
        flow = self.name("DataFlow")
        low = control.read_watermark(self.table("DataFlow"), CUSTOMER_FLOW, run_ts).first()[control.LAST]
        parts = [src[t] for t in STAGING_SOURCES["customer"]]
        build = lambda: dimensions.customer_dimension(*parts, low, run_ts, run_ts, strict, self.limits)
        # The set holds the rows of one window only, so it serves no other: else rows would be lost for good.
        staged = self.stage("customer", build, keep=True, tag=f"{low}|{run_ts}|{strict}")
        self.merge("DimCustomer", staged, "CustomerAK", "CustomerKey", "EmailAddress", run_ts, "Inferred")
        rewrite_table(control.upsert_watermark(self.table("DataFlow"), CUSTOMER_FLOW, run_ts), flow, self.keep)

    def facts_of(self, staged: DataFrame, date_key: Column) -> DataFrame:
        """The committed facts that staged orders may be among: those of their months, as an order keeps its date."""
        facts = batches.committed(self.spark, self.name("FactSales"))
        return facts if self.moving_dates else sales.within_months(facts, staged, date_key)

    def load_facts(
        self,
        staged: DataFrame,
        run_ts: datetime,
        key: str | Sequence[str] = ORDER,
        unknown_key: int | None = None,
    ) -> None:
        """Append the staged lines whose ``key`` is not in the fact table yet."""
        new = sales.new_fact_rows(staged, self.facts_of(staged, F.col("OrderDateKey")), key, self.limits)
        self._append_facts(materialize(new, "new-facts"), run_ts, unknown_key)

    def new_orders(self, src: Mapping[str, DataFrame]) -> DataFrame:
        """Stored headers of the orders that are not in the fact table yet."""
        header = src["SalesOrderHeader"]
        facts = self.facts_of(header, calendar_key(F.col("OrderDate")))
        return materialize(sales.new_headers(header, facts, ORDER, self.limits), "new-orders")

    def new_lines(
        self,
        src: Mapping[str, DataFrame],
        line_order: Sequence[str] = ("SalesOrderDetailID",),
        key: str | Sequence[str] = ORDER,
    ) -> DataFrame:
        """Stage the order lines that are not in the fact table yet.

        Where whole orders are compared, known ones are left out before their
        lines are looked at, so a small addition costs no shuffle of all lines.
        """
        whole_orders, built = key in WHOLE_ORDERS, []

        def build():
            built.append(True)
            header = self.new_orders(src) if whole_orders else src["SalesOrderHeader"]
            detail, product = src["SalesOrderDetail"], src["Product"]
            return sales.stage_sales(
                header, detail, product, line_order, whole_orders, self.limits, self.number_all_lines,
                costs=sales.cost_blocks(detail, product, self.limits),
                by_month=whole_orders and self.files is not None,
                amounts=False,
            )

        # Totals of an order repeat in its lines and take hardly any room; what follows from them would.
        tag = f"{as_list(key)}|{list(line_order)}|{self.number_all_lines}|totals"
        staged = sales.with_amounts(self.stage("sales", build, tag=tag))
        if self.files is None and whole_orders:
            return materialize(staged, "new-facts")
        if built and whole_orders:
            return staged  # stored, and without the orders in the fact table
        # A kept staging set may be older than the fact table; what is left of it need not lie together by month.
        staged = staged.drop(ORDER_MONTH)
        facts = self.facts_of(staged, F.col("OrderDateKey"))
        return materialize(sales.new_fact_rows(staged, facts, key, self.limits), "new-facts")

    def _enter_customers(self, mentioned: DataFrame, run_ts: datetime, last: int) -> None:
        """Customers nobody has heard of get a key before the facts that mention them."""
        known = self.current("DimCustomer", last)
        options = {"limits": self.limits, "reserve": self.reserve("DimCustomer")}
        self.add("DimCustomer", inferred_members(mentioned, known, "CustomerAK", "CustomerKey", run_ts, **options), last)

    def _write_facts(self, rows: DataFrame, run_ts: datetime) -> None:
        """Append a batch; rows that have their month already lie together by it."""
        together = ORDER_MONTH in rows.columns
        if not together:
            rows = rows.withColumn(ORDER_MONTH, sales.order_month(F.col("OrderDateKey")))
        batches.append_batch(rows, self.name("FactSales"), run_ts, together)

    def _append_orders(
        self,
        header: DataFrame,
        src: Mapping[str, DataFrame],
        line_order: Sequence[str],
        run_ts: datetime,
        unknown_key: int | None = None,
    ) -> None:
        """The facts of stored new orders, in one go: lines are shuffled by order and for the files, and not stored between.

        Keys of the parties are looked up in the headers, so a dimension too big to broadcast costs a shuffle of those.
        """
        detail, product = src["SalesOrderDetail"], src["Product"]
        costs = sales.cost_blocks(detail, product, self.limits)
        last = batches.last_batch(self.spark, self.name("DimCustomer"))
        self._enter_customers(sales.ordering_customers(header, detail, product, True, self.limits, costs), run_ts, last)
        of_order = sales.order_roles(
            self.current("DimCustomer", last),
            self.current("DimEmployee"),
            self.table("DimGeography"),
            self.table("DimSalesTerritory"),
        )
        of_line = sales.line_roles(self.table("DimPromotion"), self.table("DimProduct"), "_offer", "_product")
        options = {"unknown_key": unknown_key, "limits": self.limits}
        copies = {"_offer": F.col("SpecialOfferID"), "_product": F.col("ProductID")}  # lookups replace what they look up
        ways = lookup_ways(detail.withColumns(copies).schema, of_line, limits=self.limits)
        rows = sales.stage_sales(
            header, detail, product, line_order, True, self.limits, self.number_all_lines,
            order_keys=lambda orders: lookup_keys(orders, of_order, **options),
            line_keys=lambda lines: lookup_keys(lines.withColumns(copies), of_line, ways=ways, **options),
            costs=costs,
            by_month=not any(way.shuffles for way in ways),
        )
        self._write_facts(rows, run_ts)

    def _append_facts(self, lines: DataFrame, run_ts: datetime, unknown_key: int | None = None) -> None:
        """Look up the keys of stored new lines; customers nobody has heard of are entered first."""
        last = batches.last_batch(self.spark, self.name("DimCustomer"))
        self._enter_customers(lines, run_ts, last)
        rows = sales.fact_rows(
            lines,
            self.current("DimCustomer", last),
            self.current("DimEmployee"),
            self.table("DimPromotion"),
            self.table("DimProduct"),
            self.table("DimGeography"),
            self.table("DimSalesTerritory"),
            unknown_key,
            self.limits,
        )
        self._write_facts(rows, run_ts)

    def run(
        self,
        src: Mapping[str, DataFrame] | None,
        run_ts: datetime,
        calendar: tuple[str | date, str | date] = CALENDAR,
        line_order: Sequence[str] = ("SalesOrderDetailID",),
        fact_key: str | Sequence[str] = ORDER,
        unknown_key: int | None = None,
        strict: bool = False,
    ) -> None:
        """All dimensions, the calendar and the new orders, or kept order lines, at once, then the facts.

        ``src`` names the source tables; None stands for those below the source folder.
        """
        src = self.sources() if src is None else src
        by_order = self.files is None and fact_key in WHOLE_ORDERS
        with scratch_folder(self.spark, "load"):
            *_, new = self._together(
                *self._dimension_loads(src, run_ts),
                lambda: self.load_customers(src, run_ts, strict),
                lambda: load_calendar(self.name("DimDate"), *calendar, self.spark),
                lambda: self.new_orders(src) if by_order else self.new_lines(src, line_order, fact_key),
            )
            if by_order:
                self._append_orders(new, src, line_order, run_ts, unknown_key)
            else:
                self._append_facts(new, run_ts, unknown_key)

    def row_counts(self, *tables: str) -> DataFrame:
        """Rows per table: one small frame to look at after a run."""
        names = tables or ("DimCustomer", "DimProduct", "DimPromotion", "DimSalesTerritory", "DimGeography",
                           "DimEmployee", "DimDate", "FactSales")
        counts = [self.table(t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("rows")) for t in names]
        total = counts[0]
        for one in counts[1:]:
            total = total.unionByName(one)
        return total
