"""Values by integer id in a broadcast that holds little more than the values.

64 neighbouring ids share a row: a bit mask tells which of them are there, and an array has their values in order.
A member costs a few bytes then instead of a hash table entry of its own, so a table of some ten million members is
still no large broadcast, and the rows that look it up are not shuffled.  Ids that lie far apart gain nothing: the
size is measured.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..limits import DEFAULT, Limits
from ..scratch import materialize

# A generous size of a block in a hash table, besides its values.
_BLOCK_BYTES = 96

_WIDTHS = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.LongType: 8}


@dataclass(frozen=True)
class Blocks:
    rows: DataFrame  # _block, _mask and, for values, _values
    bytes: int
    kind: T.DataType | None = None  # of the values


def _number(key: str) -> Column:
    return F.col(f"`{key}`").cast("long")


def _place(key: str) -> Column:
    return _number(key).bitwiseAND(F.lit(63)).cast("int")


def _bit(key: str) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), _place(key))


def _is_there(key: str) -> Column:
    return F.call_function("shiftright", F.col("_mask"), _place(key)).bitwiseAND(F.lit(1)) == 1


def _width(kind: T.DataType) -> int | None:
    if isinstance(kind, T.DecimalType):
        return 8 if kind.precision <= 18 else 24
    return _WIDTHS.get(type(kind))


def _narrow(kind: T.DataType, least, greatest) -> T.DataType:
    """The narrowest type of this sort that holds all values."""
    if isinstance(kind, T.LongType) and (least is None or -(1 << 31) <= least <= greatest < 1 << 31):
        return T.IntegerType()
    if isinstance(kind, T.DecimalType) and kind.precision > 18:
        short = T.DecimalType(18, min(kind.scale, 18))
        most = 10 ** (18 - short.scale)
        if short.scale == kind.scale and (least is None or -most < least <= greatest < most):
            return short
    return kind


def _met(rows: DataFrame, blocks: DataFrame, key: str, how: str) -> DataFrame:
    return rows.withColumn("_block", F.shiftright(_number(key), 6)).join(F.broadcast(blocks), "_block", how)


def id_blocks(wanted: DataFrame, key: str, limits: Limits = DEFAULT) -> Blocks | None:
    """The ids of ``wanted``, which may repeat; None if they are no integers or too many for a broadcast."""
    if not isinstance(wanted.schema[key].dataType, T.IntegralType):
        return None
    ids = wanted.filter(_number(key).isNotNull()).select(F.shiftright(_number(key), 6).alias("_block"), _bit(key).alias("_bit"))
    masks = materialize(ids.groupBy("_block").agg(F.bit_or("_bit").alias("_mask")), "masks")
    size = masks.count() * 64
    return Blocks(masks, size) if size <= limits.broadcast_bytes else None


def value_blocks(df: DataFrame, key: str, value: str, limits: Limits = DEFAULT, most: int | None = None) -> Blocks | None:
    """``value`` by ``key``, within ``most`` bytes (the broadcast limit by default).

    None if that is too little, ids are no integers, an id comes twice, or values have no fixed width.
    """
    kind, most = df.schema[value].dataType, limits.broadcast_bytes if most is None else most
    if not isinstance(df.schema[key].dataType, T.IntegralType) or _width(kind) is None or most < 0:
        return None
    member = F.struct(_place(key).alias("at"), F.col(f"`{value}`").alias("value"))
    found = (
        df.filter(_number(key).isNotNull())
        .groupBy(F.shiftright(_number(key), 6).alias("_block"))
        .agg(F.bit_or(_bit(key)).alias("_mask"), F.array_sort(F.collect_list(member)).alias("_members"))
        .select("_block", "_mask", F.transform("_members", lambda m: m["value"]).alias("_values"))
    )
    stored = materialize(found, "blocks")
    told = stored.agg(
        F.count(F.lit(1)).alias("blocks"),
        F.coalesce(F.sum(F.size("_values")), F.lit(0)).alias("members"),
        F.coalesce(F.max(F.size("_values") != F.bit_count("_mask")), F.lit(False)).alias("repeated"),
        F.min(F.array_min("_values")).alias("least"),
        F.max(F.array_max("_values")).alias("greatest"),
    ).first()  # one row
    narrow = _narrow(kind, told["least"], told["greatest"])
    size = told["blocks"] * _BLOCK_BYTES + told["members"] * _width(narrow)
    if told["repeated"] or size > most:
        return None
    values = F.col("_values").cast(T.ArrayType(narrow))
    return Blocks(stored.select("_block", "_mask", values.alias("_values")), size, kind)


def rows_in(rows: DataFrame, blocks: Blocks, key: str) -> DataFrame:
    """The rows whose ``key`` is among the ids: no shuffle."""
    return _met(rows, blocks.rows.select("_block", "_mask"), key, "inner").filter(_is_there(key)).select(*rows.columns)


def with_values(rows: DataFrame, blocks: Blocks, key: str, name: str, how: str = "left") -> DataFrame:
    """Add the value of each row's ``key`` as ``name``; without one it is NULL, or with an inner join the row is left out."""
    met = _met(rows, blocks.rows, key, how)
    if how == "inner":
        met = met.filter(_is_there(key))
    lower = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), _place(key)))
    value = F.get("_values", F.bit_count(F.col("_mask").bitwiseAND(lower)))
    found = F.when(_is_there(key), value) if how == "left" else value
    return met.select(*[F.col(f"`{c}`") for c in rows.columns], found.cast(blocks.kind).alias(name))
