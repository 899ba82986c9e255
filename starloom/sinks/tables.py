"""Writing staging sets and warehouse tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.members import conform
from ..scratch import COMPRESSION, remove_folder
from ..sources.schemas import WAREHOUSE_TABLES


def create_tables(
    spark: SparkSession,
    database: str,
    tables: Mapping[str, str] = WAREHOUSE_TABLES,
    location: str | None = None,
) -> None:
    """Create the schema and its Parquet tables where they do not exist yet."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database}{where}")
    for name, columns in tables.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}")


def write_staging(df: DataFrame, path: str) -> DataFrame:
    """Replace a Parquet staging set and return it as stored."""
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Replace a table that is bucketed and sorted by ``key``: joins and groups by that key need no shuffle of it.

    Rows are brought together by bucket first, so each bucket is one file.
    """
    df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def append_table(df: DataFrame, table: str) -> None:
    """Append by column name, with the types of the table; a value that does not fit raises."""
    conform(df, df.sparkSession.table(table)).write.mode("append").format("parquet").saveAsTable(table)


def _location(spark, table: str) -> str:
    """The folder of a table, from the part of its description that comes after the columns."""
    told = [(r["col_name"], r["data_type"]) for r in describe_table(spark, table).collect()]
    details = told[[name for name, _ in told].index("# Detailed Table Information") :]
    return dict(details)["Location"].rstrip("/")


def rewrite_table(df: DataFrame, table: str, keep: int | None = None) -> None:
    """Replace the rows of a table that ``df`` may itself read.

    The new rows are written once, to a fresh folder beside the old one; then the
    table is pointed at it.  Until that moment readers see the old rows, and a
    failed write leaves the table as it was.  Folders of the last ``keep`` rewrites stay, for
    readers that started earlier; without it, all do.
    """
    spark = df.sparkSession
    current = spark.table(table)
    place = _location(spark, table)
    parent, name = place.rsplit("/", 1)
    base, _, old = name.partition("__v_")
    number = int(old.split("_")[0]) if old else 0
    target = f"{parent}/{base}__v_{number + 1}_{uuid.uuid4().hex}"
    conform(df, current).write.parquet(target)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{target}'")
    spark.catalog.refreshTable(table)
    if keep is not None:
        for folder in _rewrites(spark, parent, base):
            if int(folder.rsplit("__v_", 1)[1].split("_")[0]) <= number + 1 - max(keep, 1):
                remove_folder(spark, folder)


def _rewrites(spark: SparkSession, parent: str, base: str) -> list[str]:
    """The folders that rewrites of a table made, those of failed ones included."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{parent}/{base}__v_*")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    return [status.getPath().toString() for status in found or []]
