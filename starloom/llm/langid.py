"""Language identification by multilingual mixture inference.

A language is a distribution over hashed byte trigrams, learned from all labelled
texts by counting.  A text is a mixture of languages: expectation-maximisation
estimates its proportions from the likelihoods of its trigrams.  Which languages
are in the mixture is decided by penalised likelihood: languages enter by their weight in
the fit with all of them, any number of them, and a further language must
raise the likelihood by more than its parameter costs.  The prediction is
the language with the largest proportion, and the score is that proportion.  A text in
one language has the whole proportion; its score is then the posterior probability
of that language, so a text of a few letters is not called certain.

Counts are summed task by task; the model has one vector per language.

Defined cases: NULL texts and texts without a letter are ``und`` with score 0, as
are all texts if no language was learned; a text whose letters are no evidence gets the
language with the largest learned share, and that share; of equal languages the first by name
counts; texts of any length are looked at whole; rows without lang teach nothing; rows that repeat an
id are scored each, equal texts alike; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import fold, map_arrow
from .sums import vector_sums
from .words import pieces

FOLDS, HELD_OUT = 4, 2
BUCKETS = 4096
ROUNDS = 8
LEAST_WEIGHT = 0.02  # a language below this in the fit with all languages is not tried
UNKNOWN = "und"
_ROWS = 512

# Letters in lower case, all else is one blank.
LETTERS = np.full(256, 32, dtype=np.uint8)
LETTERS[97:123] = range(97, 123)
LETTERS[65:91] = range(97, 123)
LETTERS[128:] = range(128, 256)


def trigram_counts(texts: pa.Array) -> Iterator[np.ndarray]:
    """Matrices of texts by trigram buckets, for some texts at a time."""
    for piece in pieces(texts, most_rows=_ROWS):
        rows, n = piece.last - piece.first, len(piece.data)
        if n == 0:
            yield np.zeros((rows, BUCKETS), np.float32)
            continue
        # A blank before each text and after the last, so the edges of texts are edges of words.
        f = np.append(np.insert(LETTERS[piece.data], piece.bounds[:-1], 32), 32).astype(np.uint32)
        row = np.append(np.repeat(np.arange(rows), np.diff(piece.bounds) + 1), rows)
        edge = np.zeros(len(f), bool)
        edge[piece.bounds + np.arange(rows + 1)] = True
        code = (f[:-2] << 16) | (f[1:-1] << 8) | f[2:]
        # Around a byte of a text, and not two blanks in a row.
        good = ~edge[1:-1] & ~((f[1:-1] == 32) & ((f[:-2] == 32) | (f[2:] == 32)))
        bucket = (code[good] * np.uint32(0x9E3779B1)) >> np.uint32(32 - 12)
        flat = np.bincount(row[1:-1][good] * BUCKETS + bucket, minlength=rows * BUCKETS)
        yield flat.reshape(rows, BUCKETS).astype(np.float32)


@dataclass
class Languages:
    names: list[str]
    p: np.ndarray  # languages x buckets, probabilities
    share: np.ndarray  # of all trigrams learned from

    def mixtures(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The main language of each row and its proportion."""
        n, k = len(counts), len(self.names)
        total = np.maximum(counts.sum(axis=1), 1)
        # Neighbouring trigrams share two of three letters, so they count as a third each.
        single = (counts @ np.log(self.p).T).astype(np.float64) / 3
        posterior = single + np.log(self.share)
        posterior = np.exp(posterior - posterior.max(axis=1, keepdims=True))
        posterior /= posterior.sum(axis=1, keepdims=True)
        best = posterior.argmax(axis=1)
        share = posterior.max(axis=1)
        if k == 1:
            return best, share
        weights = self._fit(counts, np.full((n, k), 1 / k, np.float32), total)
        order = np.argsort(-weights, axis=1, kind="stable")
        value = single.max(axis=1)
        penalty = 0.5 * np.log(total + 1)
        for size in range(2, k + 1):
            rows = np.flatnonzero((weights[np.arange(n), order[:, size - 1]] > LEAST_WEIGHT) & (counts.sum(axis=1) > 0))
            if not len(rows):
                break
            allowed = np.zeros((len(rows), k), np.float32)
            np.put_along_axis(allowed, order[rows, :size], weights[rows[:, None], order[rows, :size]] + 1e-3, axis=1)
            some = self._fit(counts[rows], allowed / allowed.sum(axis=1, keepdims=True), total[rows])
            likely = (counts[rows] * np.log(some @ self.p)).sum(axis=1) / 3 - (size - 1) * penalty[rows]
            up = likely > value[rows]
            at = rows[up]
            value[at], best[at], share[at] = likely[up], some[up].argmax(axis=1), some[up].max(axis=1)
        return best, share

    def _fit(self, counts: np.ndarray, weights: np.ndarray, total: np.ndarray) -> np.ndarray:
        for _ in range(ROUNDS):
            weights = weights * ((counts / (weights @ self.p)) @ self.p.T) / total[:, None].astype(np.float32)
            weights = np.maximum(weights, 0)
            sums = weights.sum(axis=1, keepdims=True)
            weights = np.where(sums > 0, weights / np.maximum(sums, 1e-30), 1 / weights.shape[1]).astype(np.float32)
        return weights


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Languages:
    """Trigram counts of all texts with a language outside of the held-out fold."""
    train = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text"), fold(id_col, FOLDS).alias("fold"))
    train = train.filter(f"lang is not null and text is not null and fold <> {HELD_OUT}").select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, at = np.array(batch.column(0).to_pylist(), object), 0
            for counts in trigram_counts(batch.column(1)):
                some = langs[at : at + len(counts)]
                at += len(counts)
                for lang in set(some):
                    sums[lang] = sums.get(lang, 0) + counts[some == lang].sum(axis=0, dtype=np.float64)
        if sums:
            raw = pa.array([v.tobytes() for v in sums.values()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), raw], names=["key", "vector"])

    counts = vector_sums(train.mapInArrow(run, "key string, vector binary"))
    names = sorted(counts)
    if not names:
        return Languages([], np.zeros((0, BUCKETS), np.float32), np.zeros(0))
    table = np.array([counts[n] for n in names]) + 0.5
    sums = table.sum(axis=1, keepdims=True)
    return Languages(names, (table / sums).astype(np.float32), sums[:, 0] / sums.sum())


def identify(docs: DataFrame, model: Languages, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (fold(id_col, FOLDS) == HELD_OUT).alias("held_out"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"),
        text.alias("text"),
    )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        letters = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        names, score = np.full(len(letters), UNKNOWN, object), np.zeros(len(letters))
        if model.names:
            at, known = 0, np.array(model.names, object)
            for counts in trigram_counts(batch.column(3)):
                best, share = model.mixtures(counts)
                names[at : at + len(best)], score[at : at + len(best)] = known[best], share
                at += len(best)
        names[~letters], score[~letters] = UNKNOWN, 0.0
        columns = [batch.column(0), batch.column(1), pa.array(names.tolist(), pa.string()), pa.array(np.clip(score, 0, 1))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(rows, work, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
