"""Text quality by ridge regression on random Fourier features of document statistics.

A text is described by some twenty statistics of its characters, words and
lines.  Random cosines of the standardised statistics approximate a Gaussian
kernel; ridge regression on them needs only the normal equations, which are
summed over the tasks of all labelled rows.  Scores are then calibrated by
isotonic regression on a histogram of the labelled rows.

Defined cases: NULL and empty texts have statistics of zero and a score like any
other; without labels of both kinds all texts get the share of good labels (0
without labels); of several labels of one id the largest counts; rows that
repeat an id are scored each; an empty table gives no rows; other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..scratch import materialize
from .common import fold, map_arrow
from .sums import vector_sums
from .words import mix64, pieces, words

FEATURES = 256
WIDTH = 4.0  # of the kernel, in standard deviations
RIDGE = 1e-3  # per labelled row
BINS = 1024
FOLDS = 5
THRESHOLD = 0.3
SEED = 11

_KINDS = np.zeros(256, np.uint8)  # 1 lower, 2 upper, 3 digit, 4 blank, 5 line end, 6 other ASCII, 7 beyond ASCII
_KINDS[33:128] = 6
_KINDS[97:123], _KINDS[65:91], _KINDS[48:58] = 1, 2, 3
_KINDS[[32, 9, 11, 12, 13]], _KINDS[10], _KINDS[128:] = 4, 5, 7
_MARKS = tuple(b"!?.,|:;-/<>{}@#")


def statistics(texts: pa.Array) -> Iterator[np.ndarray]:
    """Rows of statistics of each text, for some texts at a time."""
    for piece in pieces(texts):
        rows = piece.last - piece.first
        row = np.repeat(np.arange(rows), np.diff(piece.bounds))
        chars = np.diff(piece.bounds).astype(float)
        kind = np.bincount(row * 8 + _KINDS[piece.data], minlength=rows * 8).reshape(rows, 8)
        per_char = np.maximum(chars, 1)
        w = words(piece)
        count = np.bincount(w.row, minlength=rows).astype(float)
        per_word = np.maximum(count, 1)
        length = (w.end - w.start).astype(float)
        mean = np.bincount(w.row, length, rows) / per_word
        spread = np.sqrt(np.maximum(np.bincount(w.row, length**2, rows) / per_word - mean**2, 0))

        def repeated(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
            """The share of items that are met again in their text."""
            total = np.bincount(at, minlength=rows)
            distinct = np.bincount(at[_first_of(hashes, at)], minlength=rows)
            return 1 - distinct / np.maximum(total, 1)

        def runs(size: int) -> np.ndarray:
            if len(w.hashes) <= size:
                return np.zeros(rows)
            h = w.hashes[: len(w.hashes) - size].copy()
            for i in range(1, size + 1):
                h = mix64(h * np.uint64(31) + w.hashes[i : len(w.hashes) - size + i])
            same = w.row[size:] == w.row[: len(w.row) - size]
            return repeated(h[same], w.row[size:][same])

        marks = [np.bincount(row[piece.data == m], minlength=rows) / per_char for m in _MARKS]
        yield np.column_stack(
            [
                np.log1p(chars),
                np.log1p(count),
                mean,
                spread,
                *(kind[:, k] / per_char for k in range(1, 8)),
                kind[:, 2] / np.maximum(kind[:, 1] + kind[:, 2], 1),
                repeated(w.hashes, w.row),
                runs(1),
                runs(4),
                np.bincount(w.row[length <= 2], minlength=rows) / per_word,
                *marks,
            ]
        )


def _first_of(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.unique(mix64(hashes + mix64(at.astype(np.uint64))), return_index=True)[1]


@dataclass
class Quality:
    mean: np.ndarray
    spread: np.ndarray
    direction: np.ndarray
    phase: np.ndarray
    weight: np.ndarray
    steps: tuple[np.ndarray, np.ndarray]  # of the calibration: raw score, share

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        waves = np.cos(z @ self.direction + self.phase) * np.sqrt(2 / len(self.phase))
        return np.column_stack([np.ones(len(x)), waves])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weight

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), *self.steps), 0, 1)


def isotonic(at: np.ndarray, good: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: block centres and their shares, ascending."""
    blocks: list[list[float]] = []
    for a, g, c in zip(at, good, count):
        blocks.append([a * c, g, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its statistics (binary doubles) of every row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [x.tobytes() for m in statistics(batch.column(1)) for x in m]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["doc_id", "stats"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return map_arrow(rows, work, f"doc_id {kind}, stats binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def _summed(rows: DataFrame, work) -> dict[str, np.ndarray]:
    """``work(x, y)`` gives vectors by name; they are summed over all rows of ``stats, y``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                for k, v in work(_matrix(batch.column(0)), batch.column(1).to_numpy()).items():
                    sums[k] = sums.get(k, 0) + v
        if sums:
            raw = pa.array([np.asarray(v, np.float64).tobytes() for v in sums.values()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), raw], names=["key", "vector"])

    return vector_sums(rows.mapInArrow(run, "key string, vector binary"))


def fit(
    stats: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    features: int = FEATURES,
    width: float = WIDTH,
) -> Quality | float:
    """The model, or a constant where labels of both kinds are missing.  ``stats``: of document_statistics()."""
    y = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("double").alias("y"))
    y = y.filter("doc_id is not null and y is not null").filter(fold("doc_id", FOLDS) != 0)
    y = y.groupBy("doc_id").agg(F.max("y").alias("y"))
    rows = materialize(stats.join(y, "doc_id").select("stats", "y"), "labelled")
    moments = _summed(rows, lambda x, y: {"m": np.concatenate([[len(x), y.sum()], x.sum(0), (x**2).sum(0)])})
    if not moments:
        return 0.0
    n, good, rest = moments["m"][0], moments["m"][1], moments["m"][2:]
    if good in (0, n):
        return good / n
    mean = rest[: len(rest) // 2] / n
    spread = np.sqrt(np.maximum(rest[len(rest) // 2 :] / n - mean**2, 0))
    rng = np.random.default_rng(SEED)
    direction = rng.normal(0, 1 / width, (len(mean), features))
    model = Quality(mean, np.maximum(spread, 1e-9), direction, rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1), (mean[:1], mean[:1]))

    def normal(x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        z = model.features(x)
        return {"a": (z.T @ z).ravel(), "b": z.T @ y}

    sums = _summed(rows, normal)
    a = sums["a"].reshape(features + 1, -1)
    model.weight = np.linalg.solve(a + RIDGE * n * np.diag([0.0, *np.ones(features)]) / features, sums["b"])

    def histogram(x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        s = model.raw(x)
        bins = np.clip((s + 0.5) / 2 * BINS, 0, BINS - 1).astype(int)
        return {k: np.bincount(bins, v, BINS) for k, v in (("n", np.ones(len(s))), ("y", y), ("s", s))}

    h = _summed(rows, histogram)
    some = h["n"] > 0
    model.steps = isotonic(h["s"][some] / h["n"][some], h["y"][some], h["n"][some])
    return model


def score(stats: DataFrame, model: Quality | float, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of document_statistics()."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(batch.column(2))
        s = np.full(len(x), float(model)) if isinstance(model, (int, float)) else model.scores(x)
        columns = [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    rows = stats.select("doc_id", (fold("doc_id", FOLDS) == 0).alias("held_out"), "stats")
    return map_arrow(rows, work, f"doc_id {kind}, held_out boolean, score double, predicted int")


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    stats = materialize(document_statistics(docs, id_col, text_col), "statistics")
    return score(stats, fit(stats, labels, id_col=id_col))
