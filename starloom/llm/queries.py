"""The operators of this package as queries over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..scratch import materialize
from . import (
    ann, exact_dedup, filter_audit, fim, html_extract, langid, mixing, ngram_join, packing, quality, simhash, toxicity, warc,
)
from .common import table, vocabulary


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = mixing.with_places(table(spark, sf_dir, "documents")).select("doc_id", "_key", "_size", "_place")
    placed = materialize(placed, "mix_sizes")
    drawn = mixing.draw(placed, mixing.plan_mix(placed))
    return drawn.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_words").alias("source_size"),
        F.col("_target").alias("target"),
        (F.size("_draws") * F.col("_size")).alias("taken"),
    )


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), every=20)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary(packing.VOCABULARY))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_documents(table(spark, sf_dir, "documents"))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim.transform(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_mixing": op2_mixing,
    "op3_ann": op3_ann,
    "op4_warc": op4_warc,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_langid": op8_langid,
    "op9_html": op9_html,
    "op10_quality": op10_quality,
    "op11_filter_audit": op11_filter_audit,
    "op12_simhash": op12_simhash,
    "op13_fim": op13_fim,
}
