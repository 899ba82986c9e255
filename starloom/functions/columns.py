"""Column expressions shared by the operators; all are built-in, code-generated expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# How a bit column may be spelled in an export.
TRUE_WORDS = ["1", "true"]
FALSE_WORDS = ["0", "false"]


def calendar_key(day: Column) -> Column:
    """``yyyymmdd`` as an integer; NULL for a NULL date."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def typed_null(data_type) -> Column:
    return F.lit(None).cast(data_type)


def share_of(amount: Column, part: Column, whole: Column) -> Column:
    """``amount`` spread over lines in proportion ``part / whole``; NULL when ``whole`` is 0."""
    return F.try_divide(amount * part, whole)


def parse_flag(text: Column) -> Column:
    """0/1/true/false in any case to BOOLEAN; everything else is NULL."""
    word = F.lower(F.trim(text))
    return F.when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False))


def blank_tokens(df: DataFrame, tokens: Mapping[str, Sequence[str]], to_null: bool = False) -> DataFrame:
    """Replace the listed words, and NULL, of each column by ``''`` (or by NULL if ``to_null``)."""
    empty = F.lit(None).cast("string") if to_null else F.lit("")
    return df.withColumns(
        {
            name: F.when(F.col(name).isNull() | F.col(name).isin(list(words)), empty).otherwise(F.col(name))
            for name, words in tokens.items()
        }
    )


def changed(old: Iterable[Column], new: Iterable[Column]) -> Column:
    """True if any pair differs, where NULL equals only NULL."""
    pairs = [~a.eqNullSafe(b) for a, b in zip(old, new, strict=True)]
    return reduce(lambda x, y: x | y, pairs, F.lit(False))


def in_window(stamps: Sequence[Column], low, high, strict: bool = False) -> Column:
    """Rows modified after ``low`` and no later than ``high``.

    By default one stamp may satisfy the lower bound and another the upper one.
    ``strict`` asks that the newest stamp lies in ``(low, high]``.
    """
    low, high = F.lit(low), F.lit(high)
    if strict:
        newest = F.greatest(*stamps) if len(stamps) > 1 else stamps[0]
        return (newest > low) & (newest <= high)
    after = reduce(lambda x, y: x | y, [s > low for s in stamps])
    before = reduce(lambda x, y: x | y, [s <= high for s in stamps])
    return after & before
