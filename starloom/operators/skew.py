"""Joins that neither assume a small side nor an even spread of keys.

A side is broadcast only after its size was measured.  Otherwise both sides are
shuffled, and the rows of each hot key are dealt to several tasks ("salts") in
proportion to its share; the matching rows of the other side are repeated once
per salt.  NULL counts as a key here, so a mostly empty key column does not end
up in one task either.  Each side is read once, whatever the skew.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..limits import DEFAULT, Limits
from .blocks import id_blocks, rows_in

# Hash of a hot key -> number of tasks its rows are dealt to.
HotKeys = dict[int, int]

# Generous sizes of a row and of a fixed-width column in a hash table.
_ROW_BYTES, _COLUMN_BYTES = 32, 16

_VARIABLE = (T.StringType, T.BinaryType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _size(df: DataFrame, tag: int) -> DataFrame:
    """One row: the bytes ``df`` takes once built into a hash table."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, _VARIABLE)]
    length = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in texts), F.lit(0))
    row = F.lit(_ROW_BYTES + _COLUMN_BYTES * len(df.columns)) + length
    return df.agg(F.lit(tag).alias("tag"), F.coalesce(F.sum(row.cast("long")), F.lit(0)).alias("bytes"))


def measured_bytes(dfs: Sequence[DataFrame]) -> list[int | None]:
    """The bytes each frame takes once built into a hash table; they are all measured in one job.

    Nested columns have no simple size, so a frame with one has None.
    """
    flat = [i for i, df in enumerate(dfs) if not any(isinstance(f.dataType, _NESTED) for f in df.schema)]
    if not flat:
        return [None] * len(dfs)
    sizes = reduce(DataFrame.unionAll, [_size(dfs[i], i) for i in flat]).collect()  # one row per frame
    found = {row["tag"]: row["bytes"] for row in sizes}
    return [found.get(i) for i in range(len(dfs))]


def are_small(dfs: Sequence[DataFrame], limits: Limits = DEFAULT) -> list[bool]:
    """Which frames may be broadcast, each for itself; one without a simple size is never called small."""
    return [size is not None and size <= limits.broadcast_bytes for size in measured_bytes(dfs)]


def is_small(df: DataFrame, limits: Limits = DEFAULT, count_first: bool = False) -> bool:
    """May ``df`` be broadcast?  ``count_first`` spares a table that may be huge the reading of its text."""
    if count_first and any(isinstance(f.dataType, _VARIABLE) for f in df.schema):
        if df.count() * (_ROW_BYTES + _COLUMN_BYTES * len(df.columns)) > limits.broadcast_bytes:
            return False
    return are_small([df], limits)[0]


def rows_with_ids(rows: DataFrame, wanted: DataFrame, key: str, limits: Limits = DEFAULT) -> DataFrame:
    """The rows whose integer ``key`` is among those of ``wanted``, which may have very many: no shuffle of ``rows``.

    The ids are broadcast as bit masks, one per 64 neighbouring numbers.  If they are so far apart that even the masks
    are no small side, or are no integers, all rows come back: for joins that drop the others anyway.
    """
    if not isinstance(rows.schema[key].dataType, T.IntegralType):
        return rows
    ids = id_blocks(wanted, key, limits)
    return rows if ids is None else rows_in(rows, ids, key)


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def hot_keys(df: DataFrame, keys: str | Sequence[str], limits: Limits = DEFAULT) -> HotKeys:
    """The keys that hold at least ``hot_share`` of the rows (so at most ``1 / hot_share`` keys).

    One pass over the key columns: each task fills a fixed-size frequent-items
    sketch, and sketches are merged in two levels.  The answer steers a plan and
    never its result, so the sketch error does no harm.
    """
    keys = as_list(keys)
    most = int(1 / limits.hot_share) + 1
    items = limits.sketch_items
    found = (
        df.select(key_hash(keys).alias("h"))
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(limits.sketch_groups)).alias("g"))
        .agg(F.expr(f"approx_top_k_accumulate(h, {items})").alias("s"), F.count(F.lit(1)).alias("n"))
        .groupBy(F.lit("all"))  # a group, so that no rows give no sketch instead of a failed merge
        .agg(F.expr(f"approx_top_k_combine(s, {items})").alias("s"), F.sum("n").alias("n"))
        .select("n", F.expr(f"approx_top_k_estimate(s, {most})").alias("top"))
        .first()
    )
    if found is None:
        return {}
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = {t["item"]: t["count"] / found["n"] for t in found["top"]}
    return {h: max(2, math.ceil(2 * share * tasks)) for h, share in shares.items() if share >= limits.hot_share}


def is_hot(keys: str | Sequence[str], hot: HotKeys) -> Column:
    return key_hash(as_list(keys)).isin(list(hot))


def _with_salts(df: DataFrame, keys: list[str], hot: HotKeys) -> DataFrame:
    """Add ``_salts``, the number of tasks each row's key is dealt to (NULL for ordinary keys)."""
    table = df.sparkSession.createDataFrame(list(hot.items()), "_hash long, _salts int")
    # At most 1 / hot_share rows.
    return df.withColumn("_hash", key_hash(keys)).join(F.broadcast(table), "_hash", "left").drop("_hash")


def _common_type(spark: SparkSession, a: T.DataType, b: T.DataType) -> T.DataType:
    """The type in which Spark compares values of two types."""
    if isinstance(b, T.StringType):
        a, b = b, a
    if isinstance(a, T.StringType):
        if isinstance(b, T.IntegralType):
            return T.LongType()
        return T.DoubleType() if isinstance(b, T.NumericType) else b
    null = F.lit(None)
    return spark.range(0).select(F.coalesce(null.cast(a), null.cast(b)).alias("x")).schema["x"].dataType


def _join_mixed(left: DataFrame, right: DataFrame, keys: list[str], mixed: list[str], how: str, **options) -> DataFrame:
    """Join on copies of the keys in their common types; the keys of the left side come out unchanged.

    A value without a counterpart in the common type cannot match.
    """
    copies = {k: f"_key{i}" for i, k in enumerate(mixed)}
    kinds = {k: _common_type(left.sparkSession, left.schema[k].dataType, right.schema[k].dataType) for k in mixed}

    def copied(df: DataFrame) -> DataFrame:
        return df.withColumns({copies[k]: F.col(f"`{k}`").try_cast(kinds[k]) for k in mixed})

    order = [*keys, *[c for c in left.columns if c not in keys]]
    if how in ("inner", "left"):
        order += [c for c in right.columns if c not in keys]
    on = [copies.get(k, k) for k in keys]
    joined = skew_join(copied(left), copied(right).drop(*mixed), on, how, **options)
    return joined.select(*[F.col(f"`{c}`") for c in order])


def _hashable(df: DataFrame) -> list[Column]:
    """All columns in a form that has a hash: maps do not, as their order means nothing."""
    return [F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema]


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    limits: Limits = DEFAULT,
    hot: HotKeys | None = None,
    small: bool | None = None,
) -> DataFrame:
    """``left.join(right, on, how)`` for inner, left, left_semi and left_anti joins.

    ``small`` skips the measurement of ``right`` (False for sides known to grow
    with the data); ``hot`` skips the search for hot keys of ``left``, and is
    ``{}`` where ``left`` has one row per key.
    """
    keys = as_list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    mixed = [k for k in keys if left.schema[k].dataType != right.schema[k].dataType]
    if mixed:
        hot = hot if hot == {} else None  # hot keys were hashed in another type
        return _join_mixed(left, right, keys, mixed, how, limits=limits, hot=hot, small=small)
    only_keys = how in ("left_semi", "left_anti")
    if only_keys:
        right = right.select(*keys)
    if how == "inner":
        for k in keys:  # not dropna(), which takes NaN for missing
            left = left.filter(F.col(f"`{k}`").isNotNull())
    if small is None:
        small = is_small(right, limits, count_first=only_keys)  # a fact table, perhaps
    if small:
        return left.join(F.broadcast(right), keys, how)
    if only_keys:
        right = right.distinct()  # combined before the shuffle: repeats on this side cost nothing
    if hot is None:
        hot = hot_keys(left, keys, limits)
    # A size that was measured, or is known to grow, is not left to an estimate: hence the hint.
    if not hot:
        return left.join(right.hint("merge"), keys, how)
    # Rows are dealt by their place in the order of their hashes.  Only equal rows can change places when a
    # task runs again, so the same rows are dealt the same way, and copies of one row go to different tasks.
    placed = _with_salts(left, keys, hot).withColumn("_row", F.xxhash64(*_hashable(left))).sortWithinPartitions("_row")
    deal = F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.col("_salts")).cast("int")
    dealt = placed.withColumn("_salt", F.coalesce(deal, F.lit(0))).drop("_salts", "_row")
    every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    repeated = _with_salts(right, keys, hot).withColumn("_salt", every).drop("_salts")
    return dealt.join(repeated.hint("merge"), [*keys, "_salt"], how).drop("_salt")
