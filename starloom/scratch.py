"""Run-unique folders for intermediate tables.

Intermediate data must outlive any executor, so it goes below the shared folder
named by ``spark.checkpoint.dir``.  Only a local master may fall back to a
temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Of intermediate tables, staging sets and batched tables: fewer bytes than with the default.
COMPRESSION = "zstd"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_FOLDER = "starloom.scratch"  # a local property, so threads started for the same run have it too


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used before, below the shared scratch folder."""
    if folder := spark.sparkContext.getLocalProperty(_FOLDER):
        return f"{folder}/{label}-{uuid.uuid4().hex}"
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (spark.conf.get("spark.master", "") or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="starloom-")
    return f"{root.rstrip('/')}/starloom/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the stored rows: cuts the lineage, so later
    uses neither recompute it nor depend on executors that held it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark can write to; it may be absent."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action go when it ends, and not when the driver happens to collect garbage.

    For work in many actions, none of which reads what another one shuffled.
    """
    was = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, was)


@contextmanager
def scratch_folder(spark: SparkSession, label: str) -> Iterator[None]:
    """Intermediate tables written inside go to one folder, which is removed at the end, whatever happened.

    For work whose results are stored by then: frames that read intermediate tables are void afterwards.
    Inside another such block the outer folder serves.  Shuffle files go with each action.
    """
    context = spark.sparkContext
    if context.getLocalProperty(_FOLDER):
        yield
        return
    folder = scratch_path(spark, label)
    context.setLocalProperty(_FOLDER, folder)
    try:
        with shuffles_removed(spark):
            yield
    finally:
        context.setLocalProperty(_FOLDER, None)
        remove_folder(spark, folder)
