"""Consecutive numbers over a whole table or inside groups, without a one-task window."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..limits import DEFAULT, Limits
from ..scratch import materialize
from .skew import HotKeys, as_list, hot_keys, is_hot

# monotonically_increasing_id() keeps the partition above bit 33 and the row number below it.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1

# Gives the number after which a block of keys begins, for a number of rows and a one-row frame with the largest key in use.
Reserve = Callable[[int, DataFrame], int]


def ordered_index(df: DataFrame, order_by: str | Sequence[str], name: str = "idx") -> DataFrame:
    """Add the 0-based position of each row in the order of ``order_by`` (which should be unique).

    Rows are range-partitioned, sorted inside each partition and written with
    their slot (partition, row).  A second, cheap read counts rows per partition;
    the running totals - one row per partition - are the only broadcast.  The
    slots are stored rather than recomputed because a new run of the range
    exchange may choose other bounds.
    """
    order = as_list(order_by)
    kept = [F.col(f"`{c}`") for c in df.columns]
    slots = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "ordered",
    ).withColumn("_part", F.shiftright("_slot", _ROW_BITS))
    sizes = slots.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per shuffle partition, so this window is small by construction.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    position = F.col("_start") + F.col("_slot").bitwiseAND(F.lit(_ROW_MASK))
    return slots.join(F.broadcast(starts), "_part").select(*kept, position.alias(name))


def max_key(df: DataFrame, key: str, name: str = "max_key") -> DataFrame:
    """The largest key, or 0 for an empty table, as a one-row frame."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)).cast("long").alias(name))


def assign_keys(
    df: DataFrame,
    alt_key: str | Sequence[str],
    key: str,
    after: DataFrame,
    key_type: str = "long",
    reserve: Reserve | None = None,
) -> DataFrame:
    """Dense surrogate keys in ``alt_key`` order, above the largest ``key`` of ``after``.

    The maximum stays a scalar subquery of the final plan; nothing is fetched.  With ``reserve`` the keys are those of
    a block that no other load gets; the rows are stored by then, so their count is read from footers.
    """
    rest = [c for c in df.columns if c != key]
    indexed = ordered_index(df.select(*rest), alt_key, "_idx")
    largest = max_key(after, key)
    top = largest.scalar() if reserve is None else F.lit(reserve(indexed.count(), largest))
    return indexed.select((top + F.col("_idx") + 1).cast(key_type).alias(key), *rest)


def number_in_groups(
    df: DataFrame,
    group: str | Sequence[str],
    order_by: str | Sequence[str],
    name: str,
    limits: Limits = DEFAULT,
    then: Callable[[DataFrame, HotKeys], DataFrame] | None = None,
    size_from: DataFrame | None = None,
) -> DataFrame:
    """``row_number()`` inside each group, for groups of any size.

    Ordinary groups use a window.  Hot groups are numbered through one global
    order instead, minus the position at which the group starts.

    ``then(rows, hot)`` is applied to each of the two parts before they are put
    together, so that a join on the group key can reuse the partitioning of the
    window; ``hot`` is empty for the ordinary part.  ``size_from`` is a cheaper
    frame with at least as many rows, to tell whether hot groups are possible.
    """
    groups, order = as_list(group), as_list(order_by)
    then = then or (lambda rows, _hot: rows)
    bound = df if size_from is None else size_from
    hot = {} if bound.count() <= limits.window_rows else hot_keys(bound, groups, limits)
    plain = df.filter(~is_hot(groups, hot)) if hot else df
    line: Column = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    numbered = then(plain.withColumn(name, line), {})
    if not hot:
        return numbered
    return numbered.unionByName(then(_number_hot(df.filter(is_hot(groups, hot)), groups, order, name), hot))


def _number_hot(df: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    indexed = ordered_index(df, [*groups, *order], "_idx")
    # One row per hot group: at most 1 / hot_share rows.
    match = [F.col(g).eqNullSafe(F.col(f"_{i}")) for i, g in enumerate(groups)]
    starts = indexed.groupBy(*[F.col(g).alias(f"_{i}") for i, g in enumerate(groups)]).agg(
        F.min("_idx").alias("_first")
    )
    number = (F.col("_idx") - F.col("_first") + 1).cast("int")
    return indexed.join(F.broadcast(starts), match).select(*df.columns, number.alias(name))
