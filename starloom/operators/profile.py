"""Counts and previews for watching a load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..limits import DEFAULT, Limits
from .skew import as_list, skew_join


def load_stats(staging: DataFrame, dest: DataFrame, alt_key: str, limits: Limits = DEFAULT) -> DataFrame:
    """Staged, new and already present rows, in one pass over staging.

    Rows are counted per key first, so a key counts as one row in the join however often it is staged.
    """
    known = dest.select(alt_key).distinct().withColumn("_known", F.lit(1))
    staged = staging.groupBy(alt_key).agg(F.count(F.lit(1)).alias("_rows"))
    joined = skew_join(staged, known, alt_key, "left", limits, hot={})

    def total(rows):
        return F.coalesce(F.sum(rows), F.lit(0)).cast("long")

    return joined.agg(
        total(F.col("_rows")).alias("staged"),
        total(F.when(F.col("_known").isNull(), F.col("_rows"))).alias("new_rows"),
        total(F.when(F.col("_known").isNotNull(), F.col("_rows"))).alias("existing_rows"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def preview(df: DataFrame, order_by: str | Sequence[str], rows: int = 10) -> DataFrame:
    """The first rows in a stated order (a top-k, not a full sort)."""
    return df.orderBy(*as_list(order_by)).limit(rows)
