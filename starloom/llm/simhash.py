"""Document fingerprints: SimHash, and all fingerprints within a Hamming radius by permuted block tables.

**Fingerprints.**  The terms of a text are its words (A-Z lower-cased) and its pairs
of neighbouring words.  Each distinct term has a weight that grows with the logarithm of
its count, and a hash of ``BITS`` bits; a set bit votes for, a clear one against
that bit of the fingerprint, with the weight.  The share of differing bits
estimates the angle between the weighted term vectors of two texts, and ``likeness`` is
the cosine of that angle, 0 from a right angle on.

**Radius search.**  A fingerprint is cut into ``BLOCKS`` blocks.  Two fingerprints
that differ in at most ``RADIUS`` bits agree in at least ``BLOCKS - RADIUS`` blocks, so
for every choice of that many blocks there is a table keyed by them: each such pair
meets under at least one key, and counts in the first table where it does.  Equal
fingerprints are one entry.  Entries are shuffled by table and key, sorted, and
each is compared with those after it under the same key; no pair leaves its task unless it is
within the radius.  Keys that hold very many entries (found by a sketch) are dealt to
pairs of chunks.  Nothing is dropped; fingerprints that share a key and differ
otherwise are compared one by one, so work grows with the square of their number.

**Edited texts.**  The next document, in descending order of ids, lends the first
part of its text.  Documents are dealt to ranges of ids by bounds taken from
the ids alone; the first of a range is also sent to the range before it, so every task
sees each of its documents followed by the next, and each text is shuffled once.

Defined cases: NULL and empty texts have no terms and the fingerprint 0; ids are
integers; rows that repeat an id are one document, with the greatest text; rows
without an id are one document too, the last in the order; a lone document is its
own next one; texts of any length are used whole, one at a time; equal
texts have equal fingerprints; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..limits import DEFAULT, Limits
from ..operators.skew import hot_keys, key_hash, skew_join
from ..scratch import materialize
from .words import mix64, pieces, words

BITS = 128  # two words of 64
BLOCKS = 8
RADIUS = 6
RANGE_ROWS = 20_000  # documents in a range of ids, about
MOST_RANGES = 10_000
_TERMS = 8192  # terms whose votes are added up together
_ODD = np.uint64(0x9E3779B97F4A7C15)


# -- fingerprints ---------------------------------------------------------------


def fingerprints(texts: pa.Array) -> np.ndarray:
    """An array of texts x 2 unsigned 64-bit words."""
    out = np.zeros((len(texts), BITS // 64), np.uint64)
    for piece in pieces(texts):
        w = words(piece)
        pair = np.flatnonzero(w.row[1:] == w.row[:-1])
        hashes = np.concatenate([w.hashes, mix64(w.hashes[pair] * _ODD + w.hashes[pair + 1])])
        row = np.concatenate([w.row, w.row[pair]])
        if len(row):
            order = np.lexsort((hashes, row))
            hashes, row = hashes[order], row[order]
            new = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])))
            counts = np.diff(np.append(new, len(row)))
            found, bits = _votes(hashes[new], row[new], np.rint(8 * (1 + np.log(counts))))
            out[piece.first + found] = bits
    return out


def _votes(hashes: np.ndarray, row: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that have terms, and their fingerprints.  Terms are sorted by row.

    Weights are whole numbers and are added up in steps below 2**24, so equal texts have equal sums wherever they are.
    """
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    ends = np.append(first[1:], len(row))
    lanes = np.stack([mix64(hashes + np.uint64(i) * _ODD) for i in range(BITS // 64)], axis=1).astype("<u8").view(np.uint8)
    weight = weight.astype(np.float32)
    votes = np.zeros((len(first), BITS))
    for k, (start, end) in enumerate(zip(first.tolist(), ends.tolist())):
        for s in range(start, end, _TERMS):
            e = min(end, s + _TERMS)
            votes[k] += weight[s:e] @ np.unpackbits(lanes[s:e], axis=1, bitorder="little").astype(np.float32)
    against = np.add.reduceat(weight, first, dtype=np.float64)[:, None] - votes
    return row[first], np.packbits(votes > against, axis=1, bitorder="little").view("<u8")


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of the estimated angle, 1 for equal fingerprints, not below 0."""
    return np.maximum(np.cos(np.pi * distances(a, b) / BITS), 0.0)


def as_text(fps: np.ndarray) -> list[str]:
    return [f"{hi:016x}{lo:016x}" for hi, lo in fps.tolist()]


# -- the next document ------------------------------------------------------------


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key, known, text, guest: documents in ranges of descending ids, each followed by the next, in tasks of whole ranges.

    ``guest`` rows are there as the next of the row before them only.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("key"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    named = rows.filter("key is not null").withColumn("known", F.lit(True))
    # All rows without an id are one document; a maximum is combined before the shuffle.
    nameless = rows.filter("key is null").agg(F.max("text").alias("text")).filter("text is not null")
    lowest = -(1 << 63)
    nameless = nameless.select(F.lit(lowest).cast("long").alias("key"), "text", F.lit(False).alias("known"))
    both = named.unionByName(nameless)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = named.select("key")
    ranges = min(MOST_RANGES, max(2 * tasks, math.ceil(ids.count() / RANGE_ROWS)))
    cuts = [i / ranges for i in range(1, ranges)]
    found = ids.agg(F.percentile_approx("key", cuts, 10 * ranges).alias("cuts")).first()["cuts"]  # fewer than MOST_RANGES
    bounds = np.unique(np.array(found or [], np.int64))

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(len(bounds) - np.searchsorted(bounds, key.to_numpy(), side="right")).astype("int32")

    # One row per range: its first document is the next one of the last document of the range before.
    top = both.select(range_of("key").alias("range"), "key").groupBy("range").agg(F.max("key").alias("key")).collect()
    top = sorted((r["range"], r["key"]) for r in top)
    before = {top[i][1]: top[i - 1][0] for i in range(len(top))}
    tops = np.array(sorted(before), np.int64)
    host = np.array([before[int(t)] for t in tops], np.int32)

    @F.pandas_udf("int")
    def visits(key: pd.Series) -> pd.Series:
        """The range that a document is sent to as a guest, or -1."""
        at = np.minimum(np.searchsorted(tops, key.to_numpy()), len(tops) - 1)
        return pd.Series(np.where(tops[at] == key.to_numpy(), host[at], -1)).astype("int32")

    placed = both.select("*", range_of("key").alias("range"), visits("key").alias("visits"))
    home = F.struct("range", F.lit(False).alias("guest"))
    away = F.struct(F.col("visits").alias("range"), F.lit(True).alias("guest"))
    sent = placed.select("key", "known", "text", F.explode(F.when(F.col("visits") >= 0, F.array(home, away)).otherwise(F.array(home))).alias("at"))
    sent = sent.select("at.range", "at.guest", "key", "known", "text").repartition("range")
    return sent.sortWithinPartitions("range", "guest", F.col("key").desc(), F.col("known").desc(), F.col("text").desc())


def edited(text: str, following: str) -> str:
    """The second half of ``text``, rounded down, replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_ROW = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
    "near_next double, hi long, lo long"
)


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document beside the next one: rows as ``in_order`` sorts them."""
    last = None  # range, key, known, text, fingerprint of the document that waits for its next one
    for batch in batches:
        if not batch.num_rows:
            continue
        places, guests, keys, known = (batch.column(i).to_pylist() for i in range(4))
        texts, prints = batch.column(4).to_pylist(), fingerprints(batch.column(4))
        done, new, follower = [], [], []
        for i, (place, guest, key, named) in enumerate(zip(places, guests, keys, known)):
            if last is not None and last[0] == place:
                if not guest and last[1:3] == (key, named):
                    continue  # repeats an id: the greatest text came first
                done.append(last)
                new.append(edited(last[3], texts[i]))
                follower.append(prints[i])
            last = None if guest else (place, key, named, texts[i], prints[i])
        if done:
            own, after = np.stack([d[4] for d in done]), fingerprints(pa.array(new, pa.large_string()))
            signed = own.astype(np.uint64).view(np.int64)
            columns = [
                pa.array([d[1] if d[2] else None for d in done], pa.int64()),
                pa.array([len(d[3]) for d in done], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new]),
                pa.array(as_text(own)),
                pa.array(as_text(after)),
                pa.array(likeness(own, after)),
                pa.array(likeness(own, np.stack(follower))),
                pa.array(signed[:, 0]),
                pa.array(signed[:, 1]),
            ]
            names = [c.split()[0] for c in _ROW.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names=names)


# -- all fingerprints within a radius ---------------------------------------------


def _tables(radius: int, blocks: int) -> list[tuple[int, ...]]:
    if not 0 <= radius < blocks or 64 * blocks % BITS or 64 % (BITS // blocks) or (blocks - radius) * BITS // blocks > 48:
        raise ValueError("blocks must divide a word, and those that agree make a key of 1 to 48 bits")
    return list(combinations(range(blocks), blocks - radius))


def _block(i: int, width: int) -> Column:
    word, at = divmod(i * width, 64)
    return F.shiftrightunsigned("hi" if word == 0 else "lo", at).bitwiseAND(F.lit((1 << width) - 1))


def entries(prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """hi, lo, copies and slot: a row per fingerprint and table; the slot is the table and its key."""
    width = BITS // blocks
    slots = []
    for t, agreeing in enumerate(_tables(radius, blocks)):
        slot = F.lit(t).cast("long")
        for i in agreeing:
            slot = F.shiftleft(slot, width).bitwiseOR(_block(i, width))
        slots.append(slot)
    return prints.select("hi", "lo", "copies", F.explode(F.array(*slots)).alias("slot"))


def _compare(radius: int, blocks: int):
    width = BITS // blocks
    tables = _tables(radius, blocks)
    first_table = np.full(1 << blocks, -1)  # set of agreeing blocks -> the first table they all are in
    for t, agreeing in reversed(list(enumerate(tables))):
        need = sum(1 << i for i in agreeing)
        held = np.arange(1 << blocks)
        first_table[(held & need) == need] = t
    key_bits = (blocks - radius) * width
    low = np.uint64((1 << width) - 1)

    def within(rows: dict[str, np.ndarray]) -> pa.RecordBatch | None:
        """Sorted rows of whole groups (slot, a, b): how many copies are within the radius of each."""
        slot, a, b, c = rows["slot"], rows["a"], rows["b"], rows["c"]
        prints, copies = np.stack([rows["hi"], rows["lo"]], axis=1).view(np.uint64), rows["copies"]
        start = np.flatnonzero(np.append(True, (slot[1:] != slot[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        end = np.repeat(np.append(start[1:], len(slot)), np.diff(np.append(start, len(slot))))
        near = np.zeros(len(slot), np.int64)
        at, step = np.arange(len(slot)), 0
        while True:
            step += 1
            at = at[at + step < end[at]]  # each row with the one ``step`` rows on in its group
            if not len(at):
                break
            x = prints[at] ^ prints[at + step]
            hit = np.bitwise_count(x).sum(axis=1) <= radius
            hit &= (a[at] == b[at]) | (c[at] != c[at + step])  # two chunks: pairs inside one are met elsewhere
            i, x = at[hit], x[hit]
            if len(i):
                held = np.zeros(len(i), np.int64)
                for k in range(blocks):
                    word, shift = divmod(k * width, 64)
                    held |= ((x[:, word] >> np.uint64(shift)) & low == 0).astype(np.int64) << k
                i = i[first_table[held] == slot[i] >> key_bits]
                np.add.at(near, i, copies[i + step])
                np.add.at(near, i + step, copies[i])
        some = np.flatnonzero(near)
        if not len(some):
            return None
        return pa.RecordBatch.from_arrays([pa.array(rows["hi"][some]), pa.array(rows["lo"][some]), pa.array(near[some])], names=["hi", "lo", "near"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rest = ["slot", "a", "b", "c", "hi", "lo", "copies"], None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
            if rest is not None:
                rows = {n: np.concatenate([rest[n], rows[n]]) for n in names}
            same = (rows["slot"] == rows["slot"][-1]) & (rows["a"] == rows["a"][-1]) & (rows["b"] == rows["b"][-1])
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0  # the last group may go on
            rest = {n: v[cut:] for n, v in rows.items()}
            if cut and (out := within({n: v[:cut] for n, v in rows.items()})) is not None:
                yield out
        if rest is not None and (out := within(rest)) is not None:
            yield out

    return run


def neighbours(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, limits: Limits = DEFAULT) -> DataFrame:
    """``prints``: distinct fingerprints (hi, lo) and their numbers of ``copies``.  hi, lo, near: how many copies of
    other fingerprints are within the radius; only fingerprints that have some."""
    table = entries(prints, radius, blocks)
    hot = {} if prints.count() * len(_tables(radius, blocks)) <= limits.window_rows else hot_keys(table, "slot", limits)
    if hot:
        # At most 1 / hot_share rows.
        chunks = table.sparkSession.createDataFrame(list(hot.items()), "hash long, chunks int")
        table = table.withColumn("hash", key_hash(["slot"])).join(F.broadcast(chunks), "hash", "left").drop("hash")
        table = table.withColumn("c", F.coalesce(F.pmod(F.xxhash64("hi", "lo"), F.col("chunks")).cast("int"), F.lit(0)))
        other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("chunks"), F.lit(1)) - 1))
        table = table.withColumn("other", other).withColumns({"a": F.least("c", "other"), "b": F.greatest("c", "other")})
    else:
        table = table.withColumns({n: F.lit(0) for n in ("a", "b", "c")})
    group = ["slot", "a", "b"]
    dealt = table.select("slot", "a", "b", "c", "hi", "lo", "copies").repartition(*group).sortWithinPartitions(*group)
    met = dealt.mapInArrow(_compare(radius, blocks), "hi long, lo long, near long")
    return met.groupBy("hi", "lo").agg(F.sum("near").alias("near"))


def fingerprint_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """A row per document: its fingerprint, that of its edited text, their likeness and that to the next document's,
    and ``n_near``, the number of other documents whose fingerprint is within ``radius`` bits."""
    rows = materialize(in_order(docs, id_col, text_col).mapInArrow(_follow, _ROW), "fingerprints")
    prints = materialize(rows.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("copies")), "distinct_prints")
    met = neighbours(prints, radius, blocks, limits).select("hi", "lo", F.lit(0).cast("long").alias("copies"), "near")
    near = prints.filter("copies > 1").select("hi", "lo", "copies", F.lit(0).cast("long").alias("near")).unionByName(met)
    near = near.groupBy("hi", "lo").agg((F.greatest(F.max("copies") - 1, F.lit(0)) + F.sum("near")).alias("n_near"))
    near = materialize(near, "near_prints")
    found = skew_join(rows, near, ["hi", "lo"], "left", limits)
    kind = docs.schema[id_col].dataType
    return found.select(
        F.col("doc_id").cast(kind).alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
        "near_next", F.coalesce("n_near", F.lit(0)).alias("n_near"),
    )
