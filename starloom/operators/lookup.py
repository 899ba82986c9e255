"""Surrogate-key lookups and members that facts mention before the source does."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegralType, StructType

from ..limits import DEFAULT, Limits
from .blocks import Blocks, value_blocks, with_values
from .members import conform, rows_not_in
from .numbering import Reserve, assign_keys
from .skew import HotKeys, hot_keys, is_hot, measured_bytes, skew_join


# What a pair of keys counts as in ``measured_bytes``.
_PAIR_BYTES = 64


@dataclass(frozen=True)
class Lookup:
    """One role of a dimension: ``fact_key`` holds its alternative key, ``role_key`` gets the surrogate."""

    dim: DataFrame
    fact_key: str
    role_key: str
    dim_key: str | None = None  # default: role_key
    dim_alt_key: str | None = None  # default: fact_key
    bucketed: bool = False  # ``dim`` is a table bucketed by its alternative key: it is neither broadcast nor shuffled

    def pairs(self, expiry: str) -> DataFrame:
        """Alternative key and surrogate of current versions, named as the fact needs them.

        A member with several current rows counts with the newest surrogate, so it cannot multiply facts.
        """
        dim = self.dim.filter(F.col(expiry).isNull()) if expiry in self.dim.columns else self.dim
        key = F.col(self.dim_alt_key or self.fact_key).alias(self.fact_key)
        return dim.groupBy(key).agg(F.max(self.dim_key or self.role_key).alias(self.role_key))


def _spread_lookup(fact: DataFrame, pairs: DataFrame, role: Lookup, hot: HotKeys) -> DataFrame:
    """The surrogates of one role, with no copy of a dimension row for a task that a hot key is dealt to.

    Rows with a hot key take their surrogate from a broadcast of those keys, at most ``1 / hot_share`` rows, and
    go to the big join under a hash of the row instead, so they are spread; what they meet there does not count.
    A dimension that is bucketed by the key stays where it is.
    """
    key, name = role.fact_key, role.role_key
    if not hot:
        return fact.join(pairs.hint("merge"), key, "left")
    few = pairs.filter(is_hot(key, hot)).withColumnRenamed(name, "_hot_key")
    kind = pairs.schema[key].dataType
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns]), F.lit(1 << 30)).cast(kind)
    met = fact.join(F.broadcast(few), key, "left").withColumn("_hot", is_hot(key, hot))
    met = met.withColumn("_at", F.when(F.col("_hot"), spread).otherwise(F.col(f"`{key}`")))
    found = met.join(pairs.withColumnRenamed(key, "_at").hint("merge"), "_at", "left")
    surrogate = F.when(F.col("_hot"), F.col("_hot_key")).otherwise(F.col(f"`{name}`"))
    return found.select(*[F.col(f"`{c}`") for c in fact.columns], surrogate.alias(name))


@dataclass(frozen=True)
class Way:
    """How one role is looked up: by a broadcast of its pairs, by one of blocks, or else by a shuffle."""

    role: Lookup
    pairs: DataFrame
    small: bool = False
    blocks: Blocks | None = None

    @property
    def shuffles(self) -> bool:
        return not self.small and self.blocks is None


def lookup_ways(
    schema: StructType, lookups: Sequence[Lookup], expiry: str = "ExpirationDate", limits: Limits = DEFAULT
) -> list[Way]:
    """How facts of this schema look up each role.

    All dimensions are measured in one job, each once however many roles it plays.  All roles end up in one plan, so they
    share one broadcast budget; every role has a broadcast of its own.  The smallest are broadcast as they are; of the
    others those with integer keys as blocks, as long as these fit too.
    """
    pairs = [role.pairs(expiry) for role in lookups]
    first = {id(role.dim): i for i, role in reversed(list(enumerate(lookups))) if not role.bucketed}
    sizes = dict(zip(first, measured_bytes([pairs[i] for i in first.values()]), strict=True))
    ways, left, made = {}, limits.broadcast_bytes, {}
    known = [(sizes[id(role.dim)], i) for i, role in enumerate(lookups) if sizes.get(id(role.dim)) is not None]
    for size, i in sorted(known):
        if size <= left:
            ways[i] = Way(lookups[i], pairs[i], small=True)
            left -= size
    for size, i in sorted(known):
        role, dim = lookups[i], id(lookups[i].dim)
        integers = isinstance(schema[role.fact_key].dataType, IntegralType)
        if i in ways or role.bucketed or not integers or size < limits.block_rows * _PAIR_BYTES:
            continue
        same = (dim, role.dim_key or role.role_key, role.dim_alt_key or role.fact_key)
        if same not in made:
            made[same] = value_blocks(pairs[i], role.fact_key, role.role_key, limits)
        if made[same] is not None and made[same].bytes <= left:
            ways[i] = Way(role, pairs[i], blocks=made[same])
            left -= made[same].bytes
    return [ways.get(i) or Way(role, pair) for i, (role, pair) in enumerate(zip(lookups, pairs, strict=True))]


def lookup_keys(
    fact: DataFrame,
    lookups: Sequence[Lookup],
    expiry: str = "ExpirationDate",
    unknown_key: int | None = None,
    limits: Limits = DEFAULT,
    ways: Sequence[Way] | None = None,
) -> DataFrame:
    """Replace alternative keys by surrogates; every fact row comes out exactly once.

    A fact without a match keeps a NULL key, or gets ``unknown_key`` if that is
    given.  Dimensions are broadcast where they fit together (see ``lookup_ways``, which is asked unless
    ``ways`` are given); hot keys are searched only for the others, in the fact as it came in.
    """
    staged = fact
    for way in lookup_ways(fact.schema, lookups, expiry, limits) if ways is None else ways:
        role, pair = way.role, way.pairs
        if role.bucketed and fact.schema[role.fact_key].dataType == pair.schema[role.fact_key].dataType:
            fact = _spread_lookup(fact, pair, role, hot_keys(staged, role.fact_key, limits))
        elif way.blocks:
            fact = with_values(fact, way.blocks, role.fact_key, role.role_key)
        else:
            hot = {} if way.small else hot_keys(staged, role.fact_key, limits)
            fact = skew_join(fact, pair, role.fact_key, "left", limits, hot, way.small)
        fact = fact.drop(role.fact_key)
        if unknown_key is not None:
            fact = fact.fillna({role.role_key: unknown_key})
    return fact


def lookup_key(fact: DataFrame, dim: DataFrame, dim_key: str, alt_key: str, **options) -> DataFrame:
    """A single lookup where fact and dimension use the same column names."""
    return lookup_keys(fact, [Lookup(dim, alt_key, dim_key)], **options)


def missing_members(fact: DataFrame, dim: DataFrame, alt_key: str, limits: Limits = DEFAULT) -> DataFrame:
    """Distinct alternative keys that the fact mentions and the dimension lacks."""
    mentioned = fact.select(alt_key).filter(F.col(alt_key).isNotNull()).distinct()
    return rows_not_in(mentioned, dim, alt_key, limits, hot={})


def inferred_members(
    fact: DataFrame,
    dim: DataFrame,
    alt_key: str,
    key: str,
    run_ts,
    inferred: str = "Inferred",
    load_date: str = "LoadDate",
    limits: Limits = DEFAULT,
    reserve: Reserve | None = None,
) -> DataFrame:
    """Dimension rows to append before the fact is loaded: one key per unknown member, no attributes yet."""
    unknown = assign_keys(missing_members(fact, dim, alt_key, limits), alt_key, key, after=dim, reserve=reserve)
    marks = {inferred: F.lit(1), load_date: F.lit(run_ts)}
    return conform(unknown.withColumns({c: v for c, v in marks.items() if c in dim.columns}), dim)
