"""The calendar, a source that is computed."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import calendar_key


def as_date(day: str | date) -> date:
    """A ``date``, or text in the form YYYY-MM-DD; other text raises ValueError."""
    return datetime.strptime(day, "%Y-%m-%d").date() if isinstance(day, str) else day


def calendar_days(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """Every day of ``[start, end]`` with its calendar attributes (ISO week; Sunday is day 1)."""
    days = F.sequence(F.lit(as_date(start)), F.lit(as_date(end)), F.expr("interval 1 day"))
    day = F.col("date_date")
    return spark.range(1).select(F.explode(days).alias("date_date")).select(
        calendar_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofweek(day).alias("day_of_week"),
    )
