"""Exact duplicates by a heavy-hitter split.

A Misra-Gries style frequent-items sketch over the digests finds those that may
be frequent; their exact counts are then taken, and the verified ones - at most
``HEAVY_ITEMS`` rows - are broadcast, so that the rows of a huge group of copies
are settled where they are read.  Only the other digests are shuffled, in groups
that are small because every large one has been taken out.

Defined cases: a NULL text counts as empty; all empty texts form one group; the
smallest non-NULL id of a group stays, and rows that repeat that id share its
fate; a group without any id keeps all its rows; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from ..scratch import materialize
from .common import SPACES, drop_ids

# Items of the sketch, which bounds the broadcast; groups below HEAVY_ROWS are not worth it.
HEAVY_ITEMS = 16384
HEAVY_ROWS = 64


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and SHA-256 of the text in which each run of white space is one space."""
    text = F.regexp_replace(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), SPACES, " ")
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"))


def heavy_digests(rows: DataFrame, items: int = HEAVY_ITEMS, least: int = HEAVY_ROWS) -> DataFrame:
    """Digests with at least ``least`` rows among the most frequent: exact size and smallest id.

    Sketches are merged in two levels, with as many groups as each group has sketches.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, math.isqrt(tasks))
    top = (
        rows.select(F.xxhash64("digest").alias("h"))
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(groups)).alias("g"))
        .agg(F.expr(f"approx_top_k_accumulate(h, {items})").alias("s"))
        .groupBy(F.lit("all"))
        .agg(F.expr(f"approx_top_k_combine(s, {items})").alias("s"))
        .select(F.explode(F.expr(f"approx_top_k_estimate(s, {items // 4})")).alias("t"))
        .filter(F.col("t.count") >= least)
        .select(F.col("t.item").alias("h"))
    )
    # At most items / 4 rows, of one number each.
    found = rows.withColumn("h", F.xxhash64("digest")).join(F.broadcast(top), "h", "left_semi")
    exact = found.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return materialize(exact.filter(F.col("group_size") >= least), "heavy")


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    items: int = HEAVY_ITEMS,
    least: int = HEAVY_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = materialize(digests(docs, id_col, text_col), "digests")
    heavy = F.broadcast(heavy_digests(rows, items, least))  # at most items / 4 rows
    large = rows.join(heavy, "digest")
    same = Window.partitionBy("digest")
    small = rows.join(heavy, "digest", "left_anti").select(
        "digest",
        "doc_id",
        F.min("doc_id").over(same).alias("keep_id"),
        F.count(F.lit(1)).over(same).alias("group_size"),
    )
    return large.unionByName(small).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text another row with a smaller id has.

    Rows that repeat both id and text of the row that stays are reduced to one.
    Rows without an id stay, unless a row with an id has their text.
    """
    groups = materialize(exact_groups(docs, id_col, text_col), "groups")
    mark = F.unhex(F.sha2(F.regexp_replace(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), SPACES, " "), 256))
    # An id with several texts, or rows that repeat id and text: rare, settled on digests.
    odd = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1 or doc_id is null")
    odd_ids = materialize(odd.select(F.col("doc_id").alias("_odd_id")), "odd_ids")
    dropped = groups.filter("not kept").select(F.col("doc_id").alias(id_col))
    if odd_ids.isEmpty():
        return drop_ids(docs, dropped, id_col)
    is_odd = F.col(f"`{id_col}`").eqNullSafe(F.col("_odd_id"))
    plain = docs.join(odd_ids, is_odd, "left_anti")
    stay = groups.filter("kept").select(F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_digest")).distinct()
    rest = docs.join(odd_ids, is_odd, "left_semi").withColumn("_mark", mark)
    rest = rest.join(stay, F.col(f"`{id_col}`").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_digest")), "left_semi")
    rest = rest.dropDuplicates([id_col, "_mark"]).select(*[F.col(f"`{c}`") for c in docs.columns])
    return drop_ids(plain, dropped, id_col).unionByName(rest)
