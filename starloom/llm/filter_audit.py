"""What each filter removes in every order of the filters: a filter interaction audit with wide packed counters.

A document fails some of the five filters; that set is its mask.  A mask alone
decides what happens to a document at each of the 600 steps (120 orders of five
filters), so each kind of document (mask, good, toxic) is mapped to one big
integer with a field of 64 bits per step and outcome, 0 or 1.  The integers of a
part are summed with ordinary integer addition, a kind that occurs n times n-fold, and
the fields of the sum are the counts.  No field can run over into the next: it
counts documents of one part, of which there are fewer than 2**63.

Texts are looked at once, where they are read; what is kept of them (id, part,
mask, digest) is stored.  Kinds are counted per part by an ordinary aggregate,
combined before its shuffle, so a part that holds most documents costs at most 128
rows per task, and each part's sum is over at most 128 rows.  The first
document of equal texts comes from an aggregate over digests; only digests that
occur twice are joined back, in a join that splits hot digests.

Defined cases: a NULL text counts as empty, a NULL part as the empty string; a
NULL id is neither smaller nor larger than another, so its row never fails filter E
and has no label; rows that repeat an id do not fail E against each other; rows
without words pass filter B and texts without characters filter C; texts of any
length are looked at whole; a document counts as good or toxic if any of its label
rows says so; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..limits import DEFAULT, Limits
from ..operators.skew import skew_join
from ..scratch import materialize
from .common import WORDS

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = [(order, step) for order in ORDERS for step in range(len(FILTERS))]
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FIELDS = len(STEPS) * len(OUTCOMES)
FIELD_BYTES = 8

SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def text_filters(text: Column) -> list[Column]:
    """The conditions under which a text fails filters A to D."""
    words = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return [
        F.size(words) < 100,
        100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    ]


def masks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", limits: Limits = DEFAULT
) -> DataFrame:
    """doc_id, part and mask of every row: bit i says that the document fails filter ``FILTERS[i]``."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    failed = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(text_filters(F.col("text")))), F.lit(0))
    seen = materialize(rows.select("doc_id", "part", failed.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")), "masks")
    first = seen.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    first = materialize(first.filter("copies > 1 and first is not null").select("digest", "first"), "first_copies")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    both = skew_join(seen, first, "digest", "left", limits)
    return both.select("doc_id", "part", (F.col("mask") + F.when(copy, 1 << len(FILTERS) - 1).otherwise(0)).alias("mask"))


def packed(mask: int, good: bool, toxic: bool) -> int:
    """The outcomes of one document at all steps, a field each."""
    out = np.zeros((len(STEPS), len(OUTCOMES)), "<u8")
    for i, (order, step) in enumerate(STEPS):
        fails = [bool(mask >> FILTERS.index(f) & 1) for f in order]
        here, gone = fails[step], any(fails[:step])
        removed = here and not gone
        only = mask == 1 << FILTERS.index(order[step])
        out[i] = (not gone and not here, removed, here and gone, only, removed and good, removed and toxic)
    return int.from_bytes(out.tobytes(), "little")


def unpacked(total: int) -> np.ndarray:
    """Counts per step and outcome."""
    fields = np.frombuffer(total.to_bytes(FIELDS * FIELD_BYTES, "little"), "<u8")
    return fields.reshape(len(STEPS), len(OUTCOMES)).astype(np.int64)


def _sum_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = pa.array([o for o, _ in STEPS])
    steps = pa.array([s + 1 for _, s in STEPS], pa.int32())
    letter = np.array([FILTERS.index(o[s]) for o, s in STEPS])
    integer: dict[tuple, int] = {}  # at most 128
    for batch in batches:
        for part, kinds in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total = 0
            for k in kinds:
                kind = (k["mask"], k["good"], k["toxic"])
                if kind not in integer:
                    integer[kind] = packed(*kind)
                total += integer[kind] * k["n"]
            counts = unpacked(total)
            shapley = np.zeros(len(FILTERS), np.int64)
            np.add.at(shapley, letter, counts[:, OUTCOMES.index("removed")])
            columns = [pa.array([part] * len(STEPS)), names, steps]
            columns += [pa.array(counts[:, i]) for i in range(len(OUTCOMES))] + [pa.array(shapley[letter])]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *OUTCOMES, "shapley"])


def audit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    limits: Limits = DEFAULT,
) -> DataFrame:
    """A row per part, order of the filters and step, with its counts of documents."""
    label = labels.filter(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("doc_id"))
    one = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c)
    label = label.agg(one("quality"), one("toxic"))
    rows = skew_join(masks(docs, id_col, text_col, part_col, limits), label, "doc_id", "left", limits)
    marks = [F.coalesce(F.col(c), F.lit(False)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))]
    kinds = rows.groupBy("part", "mask", *marks).agg(F.count(F.lit(1)).alias("n"))
    # At most 128 kinds per part.
    parts = kinds.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("kinds"))
    return parts.mapInArrow(_sum_parts, SCHEMA)
