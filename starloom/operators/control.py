"""The load-control table: one row per flow with the end of its last good window."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

# Column names, the start of time for a flow never run, and the text form of "now".
FLOW = "DataFlowName"
LAST = "LastSuccessfulModifiedDate"
NOW = "CurrentDate"
BEGINNING = datetime(1900, 1, 1)
STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _row(control: DataFrame, flow: str, last: datetime | None) -> DataFrame:
    one = control.sparkSession.createDataFrame([(flow,)], f"{FLOW} string")
    return one.withColumn(LAST, F.lit(last).cast(control.schema[LAST].dataType))


def read_watermark(control: DataFrame, flow: str, now: datetime) -> DataFrame:
    """One row: flow, last good modification time (or the beginning of time), and the new upper bound."""
    stamp = control.schema[LAST].dataType
    # An aggregate without groups gives a row even for a flow that is not there,
    # and one row where a flow was entered twice.
    return control.filter(F.col(FLOW) == flow).agg(
        F.lit(flow).alias(FLOW),
        F.coalesce(F.max(LAST), F.lit(BEGINNING).cast(stamp)).alias(LAST),
        F.date_format(F.lit(now), STAMP_FORMAT).alias(NOW),
    )


def with_zone(window: DataFrame, column: str = "CurrentTimezone") -> DataFrame:
    """Add the session time zone, in which the bounds of a window are to be read."""
    return window.withColumn(column, F.current_timezone())


def upsert_watermark(control: DataFrame, flow: str, last: datetime) -> DataFrame:
    """The control table with the row of one flow replaced or added."""
    if last is None:
        raise ValueError("a watermark needs a timestamp")
    return control.filter(F.col(FLOW) != flow).unionByName(_row(control, flow, last))


def seed_watermark(control: DataFrame, flow: str) -> DataFrame:
    """The row to append for a flow not present yet; no row if it is."""
    return _row(control, flow, None).join(control.select(FLOW), FLOW, "left_anti")
