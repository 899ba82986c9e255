"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms (hashes of lower-cased runs of letters and digits).
The machine has a weight and a small vector per term; the inner product of two
vectors is the weight of the pair, so an insult next to the mention of a group
can count for more than both alone.

Labels come from a bounded sample (``SAMPLE`` labelled rows, those with the
smallest hash of the id).  Rows of one label whose sets of terms are equal or at
least 0.8 similar (Jaccard) count once, decided on the whole sets in the order of the
hashes, so the model does not depend on how rows are dealt to tasks.  Terms
enter by document frequency and their association with the label.  The bounded sample is
learned from in one task on an executor; the model, at most ``TERMS`` terms, is all that the driver
gets, and goes to the tasks with the code; every text, however long, is scored whole, where it is read.

Defined cases: NULL and empty texts get the score of the bias alone; without
labels of both kinds all texts get the share of toxic labels (0 without labels);
rows that repeat an id are scored each; equal texts get equal scores; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import fold, map_arrow
from .words import ALPHANUMERIC, mix64, pieces, words

SAMPLE = 12_000
TERMS = 8192
LEAST_DOCS = 5
LEAST_ODDS = 4  # standard deviations between a term's toxic share and that of all
FACTORS = 4
EPOCHS = 80
FOLDS = 5
THRESHOLD = 0.5
NEAR = (4, 5)  # similarity from which two rows of one label are near copies
BITMAPS = (256, 2048)  # bits of the bitmaps of a set, the coarse one first


@dataclass
class FactorizationMachine:
    terms: np.ndarray  # sorted hashes
    bias: float
    weight: np.ndarray
    factor: np.ndarray  # terms x factors

    def margins(self, row: np.ndarray, term: np.ndarray, rows: int) -> np.ndarray:
        """``row`` and ``term``: the places of the ones in the matrix of texts and terms."""
        out = self.bias + np.bincount(row, self.weight[term], rows)
        for f in range(self.factor.shape[1]):
            v = self.factor[term, f]
            out += 0.5 * (np.bincount(row, v, rows) ** 2 - np.bincount(row, v * v, rows))
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.empty(len(texts))
        for piece in pieces(texts):
            w = words(piece, ALPHANUMERIC)
            row, term = known(w.hashes, w.row, self.terms)
            out[piece.first : piece.last] = self.margins(row, term, piece.last - piece.first)
        return sigmoid(out)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def known(hashes: np.ndarray, row: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of row and known term."""
    if not len(terms) or not len(hashes):
        none = np.zeros(0, np.int64)
        return none, none
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    hit = terms[at] == hashes
    pair = np.unique(row[hit] * np.int64(len(terms)) + at[hit])
    return pair // len(terms), pair % len(terms)


def _features(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = []
    for piece in pieces(batch.column(3)):
        w = words(piece, ALPHANUMERIC)
        bounds = np.searchsorted(w.row, np.arange(piece.last - piece.first + 1))
        sets.extend(np.unique(w.hashes[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:]))
    return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sets, pa.binary())], names=["at", "key", "y", "terms"])


def without_copies(sets: list[np.ndarray], y: np.ndarray) -> list[int]:
    """The rows that are not near copies of a row of the same label that is kept before them.

    ``sets``: the places of each row's terms.  Bitmaps bound from above what two sets
    share; whole sets decide where the bounds allow a near copy.  Each row is held against all kept rows
    at once, so rows that share their rare terms cost no more than others.
    """
    over, under = NEAR
    size, y = np.array([len(s) for s in sets], np.int64), np.asarray(y)
    bitmaps = [_bitmaps(sets, bits) for bits in BITMAPS]
    kept, keep = np.zeros(len(sets), np.int64), 0
    coarse = np.zeros_like(bitmaps[0])  # of the kept rows, together in memory
    inside = np.zeros(1 + max((int(s.max()) for s in sets if len(s)), default=0), bool)
    for i, s in enumerate(sets):
        n = size[i]
        missing = np.bitwise_count(bitmaps[0][i] & ~coarse[:keep]).sum(axis=1, dtype=np.int64)  # at least
        rows = kept[:keep][under * (n - missing) >= over * n]  # a near copy holds 0.8 of the set
        rows = rows[(y[rows] == y[i]) & (under * np.minimum(size[rows], n) >= over * np.maximum(size[rows], n))]
        for bitmap in bitmaps:
            mine, theirs = bitmap[i], bitmap[rows]
            missing = np.bitwise_count(mine & ~theirs).sum(axis=1, dtype=np.int64)
            surplus = np.bitwise_count(theirs & ~mine).sum(axis=1, dtype=np.int64)
            common = np.minimum(n - missing, size[rows] - surplus)  # at most
            rows = rows[(over + under) * common >= over * (n + size[rows])]
        inside[s] = True
        common = np.array([np.count_nonzero(inside[sets[j]]) for j in rows.tolist()], np.int64)
        inside[s] = False
        if not (under * common >= over * (n + size[rows] - common)).any():
            kept[keep], coarse[keep] = i, bitmaps[0][i]
            keep += 1
    return kept[:keep].tolist()


def _bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    out = np.zeros((len(sets), bits // 64), np.uint64)
    for i, s in enumerate(sets):
        at = mix64(s) % np.uint64(bits)
        np.bitwise_or.at(out[i], (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return out


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, sample: int, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS
) -> DataFrame:
    """``at, key, y, text`` (hash of the id and the id as text) of at most ``sample`` labelled documents outside of fold 0."""
    y = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").cast("double").alias("y"))
    y = y.filter("_id is not null and y is not null").filter(fold("_id", folds) != 0)
    y = y.groupBy("_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("text"))
    # At most ``sample`` rows are broadcast.
    rows = texts.join(F.broadcast(y), "_id").groupBy("_id").agg(F.max("y").alias("y"), F.max("text").alias("text"))
    return rows.select(F.xxhash64("_id").alias("at"), F.col("_id").cast("string").alias("key"), "y", "text")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
    most_terms: int = TERMS,
    factors: int = FACTORS,
    epochs: int = EPOCHS,
) -> FactorizationMachine:
    """Learn in one task: the sample is bounded, and only the model comes to the driver."""
    rows = labelled_sample(docs, labels, label_col, sample, id_col, text_col)
    found = map_arrow(rows, _features, "at long, key string, y double, terms binary")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, sets = [], []
        for batch in batches:
            y += batch.column(2).to_pylist()
            sets += [np.frombuffer(raw, np.uint64) for raw in batch.column(3).to_pylist()]
        m = learned(sets, np.array(y), most_terms, factors, epochs)
        parts = [[m.bias]] + [[x.tobytes()] for x in (m.terms, m.weight, m.factor)]
        yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], names=["bias", "terms", "weight", "factor"])

    # At most ``sample`` rows, in an order that does not depend on how they were dealt to tasks.
    one = found.repartition(1).sortWithinPartitions("at", "key").mapInArrow(learn, "bias double, terms binary, weight binary, factor binary")
    row = one.first()
    if row is None:  # no task runs on an empty sample
        return learned([], np.zeros(0), most_terms, factors, epochs)
    terms, weight, factor = (np.frombuffer(bytes(row[c]), k) for c, k in (("terms", np.uint64), ("weight", float), ("factor", float)))
    return FactorizationMachine(terms, row["bias"], weight, factor.reshape(len(terms), factors))


def learned(sets: list[np.ndarray], y: np.ndarray, most_terms: int, factors: int, epochs: int) -> FactorizationMachine:
    """The model of rows with these sets of hashes and labels, near copies counted once."""
    nothing = np.zeros(0, np.uint64)
    terms, at = np.unique(np.concatenate([nothing, *sets]), return_inverse=True)
    places = np.split(at, np.cumsum([len(s) for s in sets])[:-1]) if sets else []
    keep = without_copies(places, y)
    y, places = y[keep], [places[i] for i in keep]
    share = float(y.mean()) if len(y) else 0.0
    if share in (0.0, 1.0):
        bias = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
        return FactorizationMachine(nothing, bias, np.zeros(0), np.zeros((0, factors)))
    row = np.repeat(np.arange(len(places)), [len(s) for s in places])
    at = np.concatenate(places)
    docs_ = np.bincount(at, minlength=len(terms))
    hits = np.bincount(at, y[row], len(terms))
    expected = docs_ * share
    odd = np.abs(hits - expected) / np.sqrt(np.maximum(expected * (1 - share), 1e-9))
    odd[docs_ < LEAST_DOCS] = 0
    chosen = np.sort(np.argsort(-odd, kind="stable")[:most_terms])
    chosen = chosen[odd[chosen] > LEAST_ODDS]
    place = np.full(len(terms), -1)
    place[chosen] = np.arange(len(chosen))
    inside = place[at] >= 0
    return train(row[inside], place[at[inside]], y, terms[chosen], factors, epochs)


def train(row, term, y, terms, factors: int, epochs: int, rate: float = 0.1, decay: float = 2e-5, batch: int = 128) -> FactorizationMachine:
    """Stochastic gradient descent with a step size per parameter (AdaGrad)."""
    rng = np.random.default_rng(7)
    m = FactorizationMachine(terms, 0.0, np.zeros(len(terms)), rng.normal(0, 0.02, (len(terms), factors)))
    square_w, square_v, square_b = np.full(len(terms), 1e-6), np.full((len(terms), factors), 1e-6), 1e-6
    share = y.mean()
    weight = min(10.0, np.sqrt((1 - share) / share))  # the rare kind counts more
    m.bias = float(np.log(share / (1 - share)))
    bounds = np.searchsorted(row, np.arange(len(y) + 1))
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for s in range(0, len(y), batch):
            some = order[s : s + batch]
            sizes = bounds[some + 1] - bounds[some]
            r = np.repeat(np.arange(len(some)), sizes)
            t = term[np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in some])] if sizes.sum() else term[:0]
            g = (sigmoid(m.margins(r, t, len(some))) - y[some]) * np.where(y[some] > 0, weight, 1) / len(some)
            gw = np.bincount(t, g[r], len(terms)) + decay * m.weight
            square_w += gw * gw
            sums = [np.bincount(r, m.factor[t, f], len(some)) for f in range(factors)]
            for f in range(factors):
                gv = np.bincount(t, g[r] * (sums[f][r] - m.factor[t, f]), len(terms)) + decay * m.factor[:, f]
                square_v[:, f] += gv * gv
                m.factor[:, f] -= rate * 0.2 * gv / np.sqrt(square_v[:, f])
            m.weight -= rate * gw / np.sqrt(square_w)
            gb = g.sum()
            square_b += gb * gb
            m.bias -= float(rate * gb / np.sqrt(square_b))
    return m


def score(docs: DataFrame, model: FactorizationMachine, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = model.scores(batch.column(2))
        columns = [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), (fold(id_col, FOLDS) == 0).alias("held_out"), F.col(f"`{text_col}`").alias("text"))
    return map_arrow(rows, work, f"doc_id {kind}, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: FactorizationMachine, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score at or above the threshold; rows do not move."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(model.scores(batch.column(place)) < threshold))

    return docs.mapInArrow(run, docs.schema)
