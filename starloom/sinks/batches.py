"""Tables written batch by batch: a batch can be repeated, and is seen only once it is committed.

A batched table is partitioned by the number of the batch that wrote a row and by one
column more.  Next to it stands a small table with the batches that were committed; readers look at
those only.  The next batch has the number after the last committed one, so a load that died half-way - some
files written, others not - left rows under a number that no reader looks at; the next load
clears that number and writes it anew.  Commit is the append of one row, the last step.

A table with type-2 history keeps its current versions together, in the partition of the last batch,
and closed versions where the batch that closed them put them: a change writes the current
versions and the newly closed ones, and reads no closed version.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.members import conform
from ..scratch import COMPRESSION
from .tables import append_table

BATCH = "LoadBatch"
KIND, CURRENT, CLOSED = "VersionKind", "current", "closed"


def _log(table: str) -> str:
    return f"{table}__batches"


def create_batched(spark: SparkSession, table: str, columns: str, part: str, part_type: str) -> None:
    """Create the table and its list of batches where they do not exist yet."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {BATCH} BIGINT, {part} {part_type}) USING parquet "
        f"OPTIONS (compression '{COMPRESSION}') PARTITIONED BY ({BATCH}, {part})"
    )
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_log(table)} (BatchID BIGINT, LoadedAt TIMESTAMP) USING parquet")


def last_batch(spark: SparkSession, table: str) -> int:
    """The last committed batch, 0 before the first."""
    return spark.table(_log(table)).agg(F.max("BatchID")).first()[0] or 0


def clear_batch(spark: SparkSession, table: str, batch: int, value: str | None = None) -> None:
    """Remove the rows of a batch, or of one of its partitions; no other batch is touched."""
    if spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() != "static":
        raise RuntimeError("spark.sql.sources.partitionOverwriteMode must be static to clear a batch")
    *data, _, part = spark.table(table).columns
    fixed = part if value is None else f"{part} = '{value}'"
    nothing = spark.table(table).schema
    rows = spark.createDataFrame([], nothing).select(*data, *([part] if value is None else []))
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({BATCH} = {int(batch)}, {fixed}) SELECT * FROM {{rows}}", rows=rows)


def write_batch(rows: DataFrame, table: str, batch: int, together: bool = False) -> None:
    """Write ``rows``, which have the table's second partition column, as ``batch``, whatever an earlier try left there.

    Rows are rebalanced by that column, so files have a fair size, and a value with most rows is split over tasks;
    ``together`` says that the rows of a value already lie together.
    """
    spark = rows.sparkSession
    part = spark.table(table).columns[-1]
    if not spark.table(table).filter(F.col(BATCH) == batch).isEmpty():
        clear_batch(spark, table, batch)
    batched = conform(rows.withColumn(BATCH, F.lit(batch)), spark.table(table))
    (batched if together else batched.hint("rebalance", part)).write.insertInto(table)


def commit_batch(spark: SparkSession, table: str, batch: int, at: datetime) -> None:
    """From now on readers see the batch."""
    append_table(spark.range(1).select(F.lit(batch).alias("BatchID"), F.lit(at).alias("LoadedAt")), _log(table))


def append_batch(rows: DataFrame, table: str, at: datetime, together: bool = False) -> None:
    """Append rows as the next batch: all of them or none, and once however often the load is tried."""
    batch = last_batch(rows.sparkSession, table) + 1
    write_batch(rows, table, batch, together)
    commit_batch(rows.sparkSession, table, batch, at)


def committed(spark: SparkSession, table: str) -> DataFrame:
    """The rows of all committed batches, with the partition columns."""
    return spark.table(table).filter(F.col(BATCH) <= last_batch(spark, table))


# -- type-2 history --------------------------------------------------------------


def create_versioned(spark: SparkSession, table: str, columns: str) -> None:
    create_batched(spark, table, columns, KIND, "STRING")


def versions(spark: SparkSession, table: str, last: int | None = None) -> DataFrame:
    """Current and closed versions, without the partition columns.  ``last``, here and below: the last batch, if known."""
    last = last_batch(spark, table) if last is None else last
    current = (F.col(KIND) == CURRENT) & (F.col(BATCH) == last)
    return spark.table(table).filter(current | (F.col(KIND) == CLOSED) & (F.col(BATCH) <= last)).drop(BATCH, KIND)


def current_versions(spark: SparkSession, table: str, last: int | None = None) -> DataFrame:
    """Current versions only: one partition."""
    last = last_batch(spark, table) if last is None else last
    return spark.table(table).filter((F.col(BATCH) == last) & (F.col(KIND) == CURRENT)).drop(BATCH, KIND)


def add_members(rows: DataFrame, table: str, last: int | None = None) -> None:
    """Append new members to the current versions.  A part that a dying load left is kept by the next, which adds the rest."""
    spark = rows.sparkSession
    last = last_batch(spark, table) if last is None else last
    placed = rows.withColumns({BATCH: F.lit(last), KIND: F.lit(CURRENT)})
    conform(placed, spark.table(table)).write.insertInto(table)


def write_versions(rows: DataFrame, table: str, expiry: str, at: datetime, keep: int = 2, last: int | None = None) -> None:
    """Replace the current versions by ``rows``, some of which are closed by now; older closed ones are not touched.

    Readers see the old versions until the batch is committed.  The current versions of the last ``keep``
    batches stay, for readers that started earlier; those before them are removed.
    """
    spark = rows.sparkSession
    last = last_batch(spark, table) if last is None else last
    kind = F.when(F.col(expiry).isNull(), CURRENT).otherwise(CLOSED)
    write_batch(rows.withColumn(KIND, kind), table, last + 1)
    commit_batch(spark, table, last + 1, at)
    stale = spark.table(table).filter((F.col(KIND) == CURRENT) & (F.col(BATCH) <= last + 1 - max(keep, 1)))
    for row in stale.select(BATCH).distinct().collect():  # those of earlier runs are gone: one, as a rule
        clear_batch(spark, table, row[BATCH], CURRENT)
