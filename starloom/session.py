"""Session settings for loads on a cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The scale-dependent numbers (executors, memory, shuffle partitions) belong to
# the cluster; these are the switches the operators count on.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def get_session(app: str = "starloom", time_zone: str = "UTC", **extra: str) -> SparkSession:
    """Build or reuse a session.  ``time_zone`` fixes how text is read as a timestamp."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", time_zone)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
