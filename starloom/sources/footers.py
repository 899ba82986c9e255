"""Counts and bounds of Parquet files from their footers: no column is read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# The newer Parquet reader answers COUNT, MIN and MAX from footers, if told to; a session of its own keeps these settings.
_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_bounds(spark: SparkSession, path: str, columns: Sequence[str] = (), pushed: bool = True) -> DataFrame:
    """One row: n_rows, and min_<c> and max_<c> of integer, date and boolean columns; NULL where there is no value.

    The plan belongs to a session of its own, so it can be collected but not joined, and it fails on a file
    without bounds of a column; ``known_bounds`` takes care of both.
    Columns without such statistics in their footers (text, decimals, time stamps) are read as usual.
    """
    own = spark.newSession()
    for name, value in _SETTINGS.items() if pushed else ():
        own.conf.set(name, value)
    bounds = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return own.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"), *bounds)


def known_bounds(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """``footer_bounds`` as a one-row frame of ``spark``.  The columns are read only if some file has no
    bounds of one, because it holds NULL alone there or was written without statistics."""
    found = footer_bounds(spark, path, columns)
    try:
        row = found.first()
    except Exception as error:
        if "No min/max found for Parquet file" not in str(error):
            raise
        row = footer_bounds(spark, path, columns, pushed=False).first()
    rows, *bounds = row
    return spark.createDataFrame([(rows or 0, *bounds)], found.schema)  # no files give no count
