"""The corpus pipeline: toxic documents go, then exact and near copies; the rest is mixed and packed.

Each stage takes all that its predecessor kept, as Parquet, and returns the
columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from starloom.llm.common import table, vocabulary
from starloom.scratch import materialize


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from labelled documents outside of the held-out fold."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the smallest id."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return ngram_join.drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, one output shard after another."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, vocabulary(packing.VOCABULARY))


STAGES = [
    ("toxicity", clean),
    ("exact_dedup", exact),
    ("ngram_join", near),
    ("mixing", mixture),
    ("packing", packed),
]

# The first stage applies a learned model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
