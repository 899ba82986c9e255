"""Bringing new members into a keyed dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..limits import DEFAULT, Limits
from .numbering import Reserve, assign_keys
from .skew import HotKeys, as_list, skew_join


def conform(df: DataFrame, like: DataFrame) -> DataFrame:
    """Columns of ``like`` by name in any case, with its types; absent ones become NULL.

    A value that does not fit its target type raises an error when the plan runs.
    """
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in like.schema
        ]
    )


def one_per_key(
    df: DataFrame, keys: str | Sequence[str], latest: str | Sequence[str] = (), reject: bool = False
) -> DataFrame:
    """One row per key: the one with the greatest ``latest`` columns.

    Ties are decided by the remaining columns, so the choice is repeatable.  It is
    an aggregate, combined before the shuffle: a key with very many copies costs
    one row per task.  ``reject`` raises on the first repeated key instead.
    """
    keys, latest = as_list(keys), as_list(latest)
    if reject:
        repeated = df.groupBy(*keys).count().filter("count > 1").drop("count").first()
        if repeated is not None:
            raise ValueError(f"more than one row for key {repeated.asDict()}")
        return df
    rest = [c for c in df.columns if c not in keys and c not in latest]
    if not latest and not rest:
        return df.select(*keys).distinct()
    best = df.groupBy(*keys).agg(F.max(F.struct(*latest, *rest)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.`{c}`").alias(c) for c in df.columns])


def rows_not_in(
    staged: DataFrame,
    loaded: DataFrame,
    key: str | Sequence[str],
    limits: Limits = DEFAULT,
    hot: HotKeys | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Staged rows whose key has not been loaded yet."""
    return skew_join(staged, loaded, key, "left_anti", limits, hot, small)


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` lacks; NULLs are equal here.

    Both sides meet in one aggregate, combined before its shuffle: a row with very
    many copies costs one row per task, and there is no join.
    """
    names = left.columns
    both = left.withColumn("_right", F.lit(0)).unionAll(right.withColumn("_right", F.lit(1)))
    found = both.groupBy(*[F.col(f"`{c}`") for c in names]).agg(F.max("_right").alias("_right"))
    return found.filter("_right = 0").drop("_right")


def insert_new(
    staging: DataFrame,
    dest: DataFrame,
    alt_key: str,
    key: str,
    latest: str | Sequence[str] = (),
    limits: Limits = DEFAULT,
    reject: bool = False,
    reserve: Reserve | None = None,
) -> DataFrame:
    """Rows to append to ``dest``: unknown members, each once, with new keys, of a block of their own with ``reserve``.

    A staged row without an alternative key names no member and is left out.
    Of repeated members the one with the greatest ``latest`` columns counts, or ``reject`` raises.
    """
    # Known members go first: usually most rows, and then only new ones are compared with each other.
    new = rows_not_in(staging.filter(F.col(alt_key).isNotNull()), dest, alt_key, limits)
    return conform(assign_keys(one_per_key(new, alt_key, latest, reject), alt_key, key, after=dest, reserve=reserve), dest)
