"""Sums of vectors over all rows, in levels of bounded size."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict = {}
    for batch in batches:
        for key, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            vector = np.frombuffer(raw.as_buffer(), np.float64)
            sums[key] = sums[key] + vector if key in sums else vector
    if sums:
        vectors = pa.array([v.tobytes() for v in sums.values()], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), vectors], names=["key", "vector"])


def vector_sums(partial: DataFrame) -> dict[str, np.ndarray]:
    """Sum ``vector`` (binary doubles) per ``key``.  ``partial`` has one row per task and key, so a
    middle level of about the square root of their number keeps each task's share small."""
    tasks = int(partial.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.spark_partition_id(), F.lit(max(1, math.isqrt(tasks))))
    middle = partial.withColumn("salt", salt).repartition("key", "salt").select("key", "vector").mapInArrow(_add, "key string, vector binary")
    total = middle.repartition("key").mapInArrow(_add, "key string, vector binary")
    return {r["key"]: np.frombuffer(bytes(r["vector"]), np.float64) for r in total.collect()}  # one row per key
