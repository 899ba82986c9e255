"""Deciding which staging sets were built from other files than those that are there now."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

def manifest(spark: SparkSession, source_paths: Sequence[str], tag: str = "") -> DataFrame:
    """What a staging set is built from: path, time and length of every source file, and ``tag`` for
    whatever else decides its rows.  To be taken before the sources are read."""
    rows = spark.createDataFrame([(tag, None, None)], "path string, modificationTime timestamp, length long")
    for path in source_paths:
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        rows = rows.unionByName(files.select("path", "modificationTime", "length"))
    return rows


def is_built_from(spark: SparkSession, staged_path: str, now: DataFrame) -> bool:
    """Was the set at ``staged_path`` built from exactly these files?  Any change, removal or addition counts."""
    try:
        kept = spark.read.schema(now.schema).parquet(manifest_path(staged_path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return now.exceptAll(kept).isEmpty() and kept.exceptAll(now).isEmpty()


def manifest_path(staged_path: str) -> str:
    return staged_path.rstrip("/") + "__built_from"


def mark_built(staged_path: str, now: DataFrame) -> None:
    """Keep the manifest a staging set was built from beside it; to be called once the set is stored."""
    now.write.mode("overwrite").parquet(manifest_path(staged_path))


def changed_sources(spark: SparkSession, staging: Mapping[str, tuple[str, Sequence[str]]], tag: str = "") -> DataFrame:
    """For each staging set ``name: (its path, its source paths)``: must it be rebuilt?

    It must if it was never built, or if its source files are not the very files it was built from.
    """
    said = [(name, not is_built_from(spark, path, manifest(spark, paths, tag))) for name, (path, paths) in staging.items()]
    return spark.createDataFrame(said, "staging string, rebuild boolean")  # one row per set
