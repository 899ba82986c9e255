"""A Parquet copy of source files, kept up to date file by file.

Rows are stored in one partition per version of a file: a hash of its path, time and length.
A list of the versions that count is written last, so it commits the copy.
Files that are new or changed are read, and no others; rows of a file that changed or is gone
are not listed any more.  A run that died left partitions that no list names; the
next one writes them anew.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..scratch import materialize

_LIST = "path string, modificationTime timestamp, length long, version long"
VERSION, LANDED_AT = "_version", "_landed_at"


def _version() -> list[Column]:
    """Path, time, length and version of the file of a row."""
    told = [F.col(f"_metadata.{c}") for c in ("file_path", "file_modification_time", "file_size")]
    return [c.alias(n) for c, n in zip((*told, F.xxhash64(*told)), ("path", "modificationTime", "length", "version"))]


def listed_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Path, time, length and version of every file below ``paths``; their content is not read."""
    rows = spark.createDataFrame([], _LIST)
    for path in paths:
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        rows = rows.unionByName(files.select(*_version()))
    return rows


def file_changes(kept: DataFrame, now: DataFrame) -> DataFrame:
    """path, change of every file that was ``added``, ``changed`` or ``removed``; unchanged files are left out."""
    was = kept.select("path", F.col("version").alias("was"))
    both = was.join(now.select("path", F.col("version").alias("is")), "path", "full").filter("not (was <=> is)")
    return both.select("path", F.expr("case when was is null then 'added' when is is null then 'removed' else 'changed' end").alias("change"))


def _list_of(landed: str) -> str:
    return landed.rstrip("/") + "__files"


def landed_files(spark: SparkSession, landed: str) -> DataFrame:
    """The files whose rows the copy holds; none before it is made."""
    try:
        return spark.read.schema(_LIST).parquet(_list_of(landed))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LIST)


def land(
    spark: SparkSession, paths: Sequence[str], landed: str, scan: Callable[[list[str]], DataFrame], at: datetime
) -> tuple[DataFrame, DataFrame]:
    """Bring the copy at ``landed`` up to date: its rows, with the time at which each was read, and the file changes.

    ``scan`` reads some files into rows and must not hide the ``_metadata`` column of a scan.
    """
    now = materialize(listed_files(spark, paths), "files")
    kept = materialize(landed_files(spark, landed), "files")  # stored, as the list is replaced below
    changes = file_changes(kept, now)
    fresh = [r["path"] for r in now.join(kept, "version", "left_anti").select("path").collect()]  # one row per file to read
    if fresh:
        rows = scan(fresh)
        stored = rows.select("*", F.lit(at).alias(LANDED_AT), _version()[-1].alias(VERSION))
        stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(VERSION).parquet(landed)
    now.coalesce(1).write.mode("overwrite").parquet(_list_of(landed))
    return landed_rows(spark, landed, now), changes


def landed_rows(spark: SparkSession, landed: str, now: DataFrame) -> DataFrame:
    """The rows of the listed file versions; partitions of other versions are not read.  Something must have been landed."""
    versions = [r["version"] for r in now.select("version").distinct().collect()]  # one number per file
    return spark.read.parquet(landed).filter(F.col(VERSION).isin(versions)).drop(VERSION)
