"""Keeping the calendar dimension complete."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..operators.members import except_distinct
from ..sinks.tables import append_table
from ..sources.calendar import as_date, calendar_days


def _between(days: DataFrame, start, end, column: str) -> DataFrame:
    return days.filter(F.col(column).between(F.lit(as_date(start)), F.lit(as_date(end))))


def missing_days(calendar: DataFrame, loaded: DataFrame) -> DataFrame:
    """Calendar rows not loaded yet."""
    return except_distinct(calendar, loaded.select(*calendar.columns))


def calendar_gap(days: DataFrame, start: str | date, end: str | date, column: str = "date_date") -> DataFrame:
    """Days expected in ``[start, end]`` and distinct days present, as one row."""
    return _between(days, start, end, column).agg(
        (F.datediff(F.lit(as_date(end)), F.lit(as_date(start))) + 1).alias("expected_days"),
        F.countDistinct(column).alias("present_days"),
    )


def load_calendar(table: str, start: str | date, end: str | date, spark) -> bool:
    """Append the missing days of ``[start, end]``; False if the range was already complete."""
    loaded = spark.table(table)
    gap = calendar_gap(loaded, start, end).first()
    if gap["expected_days"] == gap["present_days"]:
        return False
    append_table(missing_days(calendar_days(spark, start, end), _between(loaded, start, end, "date_date")), table)
    return True
