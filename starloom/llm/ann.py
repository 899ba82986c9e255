"""Approximate nearest neighbours by an inverted multi-index.

Both halves of the vectors are quantised separately, with ``k`` centroids each; a
cell is a pair of centroids.  A query walks the pairs in the order of their summed
inner product with its halves, taken from a heap, until the cells it has met hold
enough vectors; those are ranked again by the exact inner product.

How many are enough is measured: for a few queries the true neighbours are
found by looking at all vectors, and the walk is made as long as it must be
to meet ``RECALL`` of them.

Equal vectors are one entry.  As their scores are equal and ties go to the smaller
id, an entry needs only its ``top + 1`` smallest ids; so copies cost nothing
and nothing is lost.  Entries are dealt to buckets of bounded size, and a cell with
more entries than that is split.

Defined cases: vectors that are NULL, zero, hold NULL or non-finite components
or are not of the usual length take no part, as queries or as candidates; fewer
candidates than ``top`` are all returned; rows that repeat an id are one row per
vector; no usable vectors give no rows; other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..scratch import materialize

TOP = 20
TRAIN = 20_000  # vectors that the centroids are fitted on, by smallest hash
MOST_CENTROIDS = 1024  # per half, so a table of cells has at most 2**20 numbers
BUCKET = 16_384  # entries
RECALL = 0.96
PROBES = 96  # queries whose true neighbours are found to set the length of the walk


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v (doubles) of the vectors that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v")).filter("vec_id is not null and v is not null")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.filter(fine)
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == F.lit(usual["n"] if usual else 0))


def entries(rows: DataFrame, top: int = TOP) -> DataFrame:
    """One row per distinct vector: v and its ``top + 1`` smallest ids."""
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    first = rows.withColumn("place", place).filter(F.col("place") <= top + 1)  # limited before the shuffle too
    return first.groupBy("v").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids**2).sum(1) - 2 * x @ centroids.T).argmin(1)


def _centroids(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from ``k`` of the vectors."""
    found = x[np.random.default_rng(3).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        at = _nearest(x, found)
        count = np.bincount(at, minlength=len(found))
        sums = np.zeros_like(found)
        np.add.at(sums, at, x)
        found[count > 0] = sums[count > 0] / count[count > 0, None]
    return found


@dataclass
class MultiIndex:
    left: np.ndarray
    right: np.ndarray
    count: np.ndarray  # entries of each cell
    first: np.ndarray  # bucket of a cell, or its first one
    parts: np.ndarray  # buckets of a cell

    def cells(self, x: np.ndarray) -> np.ndarray:
        half = self.left.shape[1]
        return _nearest(x[:, :half], self.left) * len(self.right) + _nearest(x[:, half:], self.right)

    def walk(self, q: np.ndarray, enough: int) -> np.ndarray:
        """Cells that hold entries, best first, until ``enough`` entries were met."""
        half = self.left.shape[1]
        a, b = self.left @ q[:half], self.right @ q[half:]
        order_a, order_b = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
        a, b = a[order_a].tolist(), b[order_b].tolist()
        where_a, where_b = (order_a * len(self.right)).tolist(), order_b.tolist()
        met, out, count = 0, [], self.count
        heap = [(-(a[0] + b[0]), 0, 0)]
        while heap and met < enough:
            _, i, j = heapq.heappop(heap)
            cell = where_a[i] + where_b[j]
            if n := count[cell]:
                out.append(cell)
                met += int(n)
            # Each pair is pushed once: along the row, and down from the first of a row.
            if j + 1 < len(b):
                heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))
        return np.array(out, np.int64)


def build(found: DataFrame, train: int = TRAIN, bucket: int = BUCKET) -> tuple[MultiIndex, DataFrame]:
    """The index and its entries, dealt to buckets: bucket, cell, v, ids."""
    sample = found.select("v").orderBy(F.xxhash64("v")).limit(train).toArrow()  # at most ``train`` vectors
    x = _matrix(sample.column(0)) if sample.num_rows else np.zeros((0, 2))
    n = found.count()
    k = int(min(MOST_CENTROIDS, max(1, 2 ** round(np.log2(max(1, n) ** 0.5 / 4)), 1), max(1, len(x))))
    half = x.shape[1] // 2
    index = MultiIndex(_centroids(x[:, :half], k), _centroids(x[:, half:], k), *[np.zeros(k * k, np.int64)] * 3)
    lean = MultiIndex(index.left, index.right, *[np.zeros(0, np.int64)] * 3)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = lean.cells(_matrix(batch.column(0)))
                yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns], names=["cell", "v", "ids"])

    placed = materialize(found.select("v", "ids").mapInArrow(assign, "cell long, v array<double>, ids array<long>"), "cells")
    table = placed.groupBy("cell").count().toArrow()  # at most k * k numbers
    index.count = np.bincount(table.column(0).to_numpy(), table.column(1).to_numpy(), k * k).astype(np.int64)
    index.parts = np.maximum(1, -(-index.count // bucket))
    # Cells follow each other into buckets; a large cell has buckets of its own.
    index.first = np.zeros(k * k, np.int64)
    now, held = 0, 0
    for cell in np.flatnonzero(index.count):
        size = int(index.count[cell])
        if held and held + size > bucket:
            now, held = now + 1, 0
        index.first[cell] = now
        held += size
        if index.parts[cell] > 1:
            now, held = now + int(index.parts[cell]), 0
    first, parts = index.first, index.parts

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch.column(0).to_numpy()
            to = first[cell] + batch.column(1).to_numpy() % parts[cell]
            yield pa.RecordBatch.from_arrays([pa.array(to), batch.column(0), *batch.columns[2:]], names=["bucket", "cell", "v", "ids"])

    spread = placed.select("cell", F.pmod(F.xxhash64("v"), F.lit(1 << 20)).alias("h"), "v", "ids")
    return index, spread.mapInArrow(deal, "bucket long, cell long, v array<double>, ids array<long>")


def _best(score: np.ndarray, low: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` best, ties by smaller id."""
    if len(score) > 4 * top:
        edge = np.partition(score, len(score) - top)[len(score) - top]
        some = np.flatnonzero(score >= edge - 1e-12 * max(1.0, abs(edge)))
    else:
        some = np.arange(len(score))
    return some[np.lexsort((low[some], -score[some]))]


def walk_length(index: MultiIndex, placed: DataFrame, queries: DataFrame, top: int = TOP, recall: float = RECALL, probes: int = PROBES) -> int:
    """How many entries a walk must meet, from the true neighbours of a few queries among all entries."""
    some = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(probes).toArrow()
    total = int(index.count.sum())
    if total <= 4 * top or not some.num_rows:
        return max(total, 1)
    q, own = _matrix(some.column("v")), some.column("vec_id").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, cell = _matrix(batch.column(1)), batch.column(0).to_numpy()
            low = np.array([ids[0] for ids in batch.column(2).to_pylist()])
            score = x @ q.T
            for i in range(len(q)):
                at = _best(np.where(low == own[i], -np.inf, score[:, i]), low, top)[:top]
                columns = [pa.array(np.full(len(at), i)), pa.array(score[at, i]), pa.array(cell[at])]
                yield pa.RecordBatch.from_arrays(columns, names=["i", "score", "cell"])

    near = placed.select("cell", "v", "ids").mapInArrow(run, "i long, score double, cell long")
    place = F.row_number().over(Window.partitionBy("i").orderBy(F.desc("score"), "cell"))
    rows = near.withColumn("place", place).filter(F.col("place") <= top).collect()  # probes * top rows
    needed = []
    for i in range(len(q)):
        walk = index.walk(q[i], total)
        upto = dict(zip(walk.tolist(), np.cumsum(index.count[walk]).tolist()))
        needed += [upto[r["cell"]] for r in rows if r["i"] == i]
    return int(np.quantile(needed, recall))


def search(queries: DataFrame, index: MultiIndex, placed: DataFrame, enough: int, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest that each query's walk meets."""
    first, parts = index.first, index.parts

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                rows = batch.slice(s, 256)
                q = _matrix(rows.column(1)) if rows.num_rows else np.zeros((0, 2))
                bucket, row, cells = [], [], []
                for i in range(rows.num_rows):
                    walk = index.walk(q[i], enough)
                    to = np.concatenate([first[walk], *(first[c] + np.arange(1, parts[c]) for c in walk[parts[walk] > 1])])
                    of = np.concatenate([walk, *(np.full(parts[c] - 1, c) for c in walk[parts[walk] > 1])])
                    order = np.argsort(to, kind="stable")
                    for b, part in zip(*_split(to[order], of[order])):
                        bucket.append(b)
                        row.append(i)
                        cells.append(part)
                take = pa.array(row, pa.int64())
                columns = [pa.array(bucket, pa.int64()), rows.column(0).take(take), rows.column(1).take(take), pa.array(cells, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "query_id", "v", "cells"])

    asked = queries.select("vec_id", "v").mapInArrow(route, "bucket long, query_id long, v array<double>, cells array<long>")
    none = F.lit(None)
    both = placed.select("bucket", F.lit(0).alias("side"), none.cast("long").alias("query_id"), "cell", "v", "ids").unionByName(
        asked.select("bucket", F.lit(1).alias("side"), "query_id", none.cast("long").alias("cell"), "v", F.col("cells").alias("ids"))
    )
    met = both.repartition("bucket").sortWithinPartitions("bucket", "side", "query_id")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, base = -1, None
        parts_: list[pa.RecordBatch] = []
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            side = batch.column(1).to_numpy()
            cuts = np.flatnonzero((bucket[1:] != bucket[:-1]) | (side[1:] != side[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(bucket)]):
                if a == b:
                    continue
                piece = batch.slice(a, b - a)
                if side[a] == 0:
                    if bucket[a] != held:
                        held, parts_ = bucket[a], []
                    parts_.append(piece)
                    base = None
                elif bucket[a] == held:
                    base = base or _Bucket(pa.Table.from_batches(parts_))
                    for s in range(0, b - a, 128):
                        yield base.answer(piece.slice(s, 128), top)

    near = met.mapInArrow(rank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )


def _split(keys: np.ndarray, values: np.ndarray) -> tuple[list, list]:
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return keys[np.concatenate([[0], cuts])].tolist() if len(keys) else [], np.split(values, cuts) if len(keys) else []


class _Bucket:
    """The entries of one bucket."""

    def __init__(self, rows: pa.Table) -> None:
        self.x = _matrix(rows.column("v"))
        ids = rows.column("ids").combine_chunks()
        self.ids, self.at = ids.flatten().to_numpy(), np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])
        self.low = self.ids[self.at[:-1]]
        self.names, self.cell = np.unique(rows.column("cell").to_numpy(), return_inverse=True)

    def answer(self, queries: pa.RecordBatch, top: int) -> pa.RecordBatch:
        q, own = _matrix(queries.column(4)), queries.column(2).to_numpy()
        score = self.x @ q.T
        out: list[list] = [[], [], []]
        for i, cells in enumerate(queries.column(5)):
            visited = np.zeros(len(self.names), bool)
            wanted = cells.values.to_numpy()
            at = np.minimum(np.searchsorted(self.names, wanted), len(self.names) - 1)
            visited[at[self.names[at] == wanted]] = True
            rows = np.flatnonzero(visited[self.cell])
            # One more than asked for, as the query itself may be among them.
            best = rows[_best(score[rows, i], self.low[rows], top + 1)[: top + 1]]
            exact = np.array([np.dot(self.x[r], q[i]) for r in best])
            sizes = self.at[best + 1] - self.at[best]
            ids = np.concatenate([self.ids[self.at[r] : self.at[r + 1]] for r in best]) if len(best) else self.ids[:0]
            values = np.repeat(exact, sizes)
            keep = ids != own[i]
            ids, values = ids[keep], values[keep]
            order = np.lexsort((ids, -values))[:top]
            out[0] += [own[i]] * len(order)
            out[1] += ids[order].tolist()
            out[2] += values[order].tolist()
        columns = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())]
        return pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, every: int, id_col: str = "vec_id", vector_col: str = "embedding", top: int = TOP, **options) -> DataFrame:
    """Neighbours of the vectors whose id is divisible by ``every``: query_id, rank, vec_id, score."""
    rows = materialize(usable(vectors, id_col, vector_col), "vectors")
    found = materialize(entries(rows, top), "entries")
    if found.isEmpty():
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index, placed = build(found, **options)
    placed = materialize(placed, "placed")
    queries = rows.filter(F.pmod("vec_id", F.lit(every)) == 0)
    return search(queries, index, placed, walk_length(index, placed, queries, top), top)
