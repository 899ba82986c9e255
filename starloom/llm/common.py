"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..limits import DEFAULT, Limits
from ..operators.skew import is_small

# White space of the word and normalisation rules: space and U+0009 to U+000D.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The path of a public tokenizer's file, which every node has."""
    import public_tokenizers

    return public_tokenizers.path(name)


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a NULL id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def drop_ids(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", limits: Limits = DEFAULT) -> DataFrame:
    """``docs`` without the rows whose id is in ``dropped`` (one column, same name).

    Rows without an id stay.  The ids are broadcast only if their measured size
    allows it; otherwise both sides are shuffled once.
    """
    ids = dropped.select(F.col(f"`{id_col}`").alias("_dropped_id"))
    right = F.broadcast(ids) if is_small(ids, limits) else ids.hint("merge")
    return docs.join(right, F.col(f"`{id_col}`") == F.col("_dropped_id"), "left_anti")


def map_arrow(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` for work that looks at one batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := work(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)
