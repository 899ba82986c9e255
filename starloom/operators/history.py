"""Type-2 history and in-place completion of inferred members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import changed, typed_null
from ..limits import DEFAULT, Limits
from ..scratch import materialize
from .members import conform, one_per_key
from .numbering import assign_keys
from .skew import as_list, is_small, skew_join

_NEW = "_new_"


def _matched(
    dest: DataFrame,
    staging: DataFrame,
    alt_key: str,
    key: str,
    tracked: Sequence[str],
    expiry: str,
    inferred: str | None,
    latest: str | Sequence[str],
    limits: Limits,
) -> DataFrame:
    """Every ``dest`` row beside the staged row of its member, with what should happen to it.

    ``_resolve``: an inferred member whose source row has arrived.
    ``_expire``: the current version of a member, a tracked attribute of which changed.
    """
    incoming = one_per_key(staging.drop(key), alt_key, latest)
    incoming = incoming.select(
        alt_key, *[F.col(c).alias(_NEW + c) for c in incoming.columns if c != alt_key], F.lit(True).alias("_seen")
    )
    # Staging may repeat a member, so its own size is an upper bound and cheaper to take.
    both = skew_join(dest, incoming, alt_key, "left", limits, small=is_small(staging, limits))
    current = F.col(expiry).isNull() if expiry in dest.columns else F.lit(True)
    waiting = F.coalesce(F.col(inferred) == 1, F.lit(False)) if inferred else F.lit(False)
    seen = F.coalesce(F.col("_seen"), F.lit(False))
    differs = changed([F.col(c) for c in tracked], [F.col(_NEW + c) for c in tracked])
    return both.withColumns({"_resolve": seen & current & waiting, "_expire": seen & current & ~waiting & differs})


def member_changes(
    dest: DataFrame,
    staging: DataFrame,
    alt_key: str,
    key: str,
    tracked: str | Sequence[str],
    expiry: str = "ExpirationDate",
    inferred: str | None = None,
    latest: str | Sequence[str] = (),
    limits: Limits = DEFAULT,
) -> DataFrame:
    """The rows of ``dest`` that staging acts on, by key, with the new values and what should happen.  Stored:
    the join of dimension and staging runs once, and what it finds is usually small."""
    both = _matched(dest, staging, alt_key, key, as_list(tracked), expiry, inferred, latest, limits)
    kinds = {f.name.lower(): f.dataType for f in dest.schema}
    new = [c for c in staging.columns if c not in (alt_key, key) and c.lower() in kinds]
    found = both.filter("_expire OR _resolve").select(
        key, alt_key, *[F.col(_NEW + c).cast(kinds[c.lower()]).alias(_NEW + c) for c in new], "_resolve", "_expire"
    )
    return materialize(found, "changes")


def changed_members(
    dest: DataFrame,
    staging: DataFrame,
    alt_key: str,
    key: str,
    tracked: str | Sequence[str],
    expiry: str = "ExpirationDate",
    inferred: str | None = None,
    latest: str | Sequence[str] = (),
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Current versions that a staged row changes, with old and new tracked values."""
    tracked = as_list(tracked)
    both = _matched(dest, staging, alt_key, key, tracked, expiry, inferred, latest, limits)
    return both.filter("_expire").select(
        key,
        alt_key,
        *[F.col(c).alias(f"old_{c}") for c in tracked],
        *[F.col(_NEW + c).alias(f"new_{c}") for c in tracked],
    )


def apply_history(
    dest: DataFrame,
    staging: DataFrame,
    alt_key: str,
    key: str,
    tracked: str | Sequence[str],
    run_ts,
    expiry: str = "ExpirationDate",
    load_date: str = "LoadDate",
    inferred: str | None = None,
    latest: str | Sequence[str] = (),
    limits: Limits = DEFAULT,
    changes: DataFrame | None = None,
) -> DataFrame:
    """The whole dimension after the staged rows were taken in.

    * a changed current version gets ``expiry = run_ts``, and its member one new
      current version with a new key;
    * an inferred member is completed in place and keeps its key;
    * all other rows, older versions included, stay as they are.

    Old rows are updated by CASE in a join with the stored ``changes`` (found here if
    not given, see ``member_changes``), so they are not excluded by anti-joins, and
    few changes cost no shuffle of the dimension.  Keys must be unique in ``dest``.
    """
    tracked = as_list(tracked)
    if changes is None:
        changes = member_changes(dest, staging, alt_key, key, tracked, expiry, inferred, latest, limits)
    both = skew_join(dest, changes.drop(alt_key), key, "left", limits, hot={})
    both = both.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("_resolve", "_expire")})
    now = F.lit(run_ts)

    def updated(name: str) -> Column:
        value = F.col(name)
        if name in (key, alt_key):
            return value
        if name == inferred:
            value = F.when(F.col("_resolve"), F.lit(0)).otherwise(value)
        elif _NEW + name in both.columns:
            value = F.when(F.col("_resolve"), F.col(_NEW + name)).otherwise(value)
        if name == expiry:
            value = F.when(F.col("_expire"), now).otherwise(value)
        return value

    kept = conform(both.select(*[updated(c).alias(c) for c in dest.columns]), dest)
    if not tracked:
        return kept
    fixed = {load_date: now, expiry: typed_null(dest.schema[expiry].dataType)}
    if inferred:
        fixed[inferred] = F.lit(0)
    new = [c.removeprefix(_NEW) for c in changes.columns if c.startswith(_NEW)]
    fresh = (
        changes.filter("_expire")
        .select(
            alt_key,
            *[F.col(_NEW + c).alias(c) for c in new if c not in fixed],
            *[v.alias(c) for c, v in fixed.items() if c in dest.columns],
        )
        .dropDuplicates([alt_key])
    )
    return kept.unionByName(conform(assign_keys(fresh, alt_key, key, after=dest), dest))


def resolve_inferred(
    dest: DataFrame,
    staging: DataFrame,
    alt_key: str,
    key: str,
    inferred: str = "Inferred",
    expiry: str = "ExpirationDate",
    latest: str | Sequence[str] = (),
    limits: Limits = DEFAULT,
) -> DataFrame:
    """The whole dimension with arrived inferred members completed, and nothing else changed."""
    return apply_history(
        dest, staging, alt_key, key, (), None, expiry=expiry, inferred=inferred, latest=latest, limits=limits
    )
