"""Best-fit packing of token sequences by a configuration linear program.

Pieces are described by the histogram of their lengths, which has at most
``capacity`` rows whatever the size of the corpus.  A configuration is a multiset of
lengths that fits one sequence.  The linear program over configurations (cover
all pieces with as few sequences as possible) is solved by multiplicative
weights: configurations are priced by a knapsack table over the rooms of a
sequence (dynamic programming), one table gives the best configuration for every
length, and lengths whose configurations are not worth the optimum gain weight.
The solution is rounded, a program is solved again for the pieces that rounding
leaves, and the few of the last one are placed by best fit decreasing.  Pieces then
find their sequence by their number among the pieces of equal length, so no row of
the corpus is ever gathered.

Defined cases: a NULL or empty text has the end token only; a text longer than a
sequence is cut into full sequences, the first piece being the shorter one; an
empty table gives no rows; repeated rows are packed as often as they occur;
other columns are not looked at.
"""

from __future__ import annotations

import base64
import itertools
import math
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..operators.numbering import ordered_index
from ..scratch import materialize
from .words import _power, mix64

CAPACITY = 2048
END = 0
VOCABULARY = "byte_bpe_50k.tiktoken"  # the same ids as byte_bpe_50k.json
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256  # the added token of byte_bpe_50k.json
PIECE_CHARS = 1 << 18

# Classes of characters in the splitting pattern of the vocabulary.
_LETTER, _NUMBER, _OTHER, _SPACE, _UNKNOWN = 0, 1, 2, 3, 255


class Tokenizer:
    """Ids of whole batches of texts.

    The vocabulary's pattern cuts a text into short parts that are encoded on
    their own.  The cuts are found with array operations; each distinct part is
    encoded once per task.  The special token's string inside a text is that token,
    and what stands on its two sides is encoded as texts of their own.
    """

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding(
            "parts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.kind = np.full(0x110000, _UNKNOWN, np.uint8)
        self._forget()

    def _kinds(self, codes: np.ndarray) -> np.ndarray:
        kinds = self.kind[codes]
        if (kinds == _UNKNOWN).any():
            import regex

            for code in np.unique(codes[kinds == _UNKNOWN]).tolist():
                c = chr(code)
                tests = ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\p{White_Space}"))
                self.kind[code] = next((k for k, p in tests if regex.match(p, c)), _OTHER)
            kinds = self.kind[codes]
        return kinds

    def cuts(self, codes: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """Where the parts start.  ``edge``: where texts start."""
        n = len(codes)
        kinds = self._kinds(codes)
        start = edge.copy()
        start[1:] |= kinds[1:] != kinds[:-1]
        last = np.ones(n, bool)  # last of its run
        last[:-1] = start[1:]
        ends_text = np.ones(n, bool)
        ends_text[:-1] = edge[1:]
        # The last blank before something else stands alone, or joins it if it is a plain space.
        loose = (kinds == _SPACE) & last & ~ends_text
        cut = start | loose
        joins = loose & (codes == 32)
        joined = np.zeros(n, bool)
        joined[1:] = joins[:-1]
        cut &= ~joined
        # Short forms: an apostrophe alone, and the letters s, t, m, d or re, ve, ll after it.
        quote = np.flatnonzero((codes == 39) & start & last & ~joined & ~ends_text)
        if len(quote):
            def code(at: np.ndarray) -> np.ndarray:
                return codes[np.minimum(at, n - 1)]

            one = np.isin(code(quote + 1), [115, 116, 109, 100])
            inside = (quote + 2 < n) & ~ends_text[np.minimum(quote + 1, n - 1)]
            first, second = code(quote + 1), code(quote + 2)
            two = inside & (((first == 114) & (second == 101)) | ((first == 118) & (second == 101)) | ((first == 108) & (second == 108)))
            for found, size in ((quote[one], 1), (quote[two], 2)):
                cut[found + 1] = False
                rest = found + 1 + size
                cut[rest[rest < n]] = True
        return np.flatnonzero(cut)

    def _slots(self, hashes: np.ndarray, first: np.ndarray, stop: np.ndarray, text: str) -> np.ndarray:
        """The slot of each part; parts not met before are encoded."""
        found, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        where = np.searchsorted(self.known, found)
        new = np.ones(len(found), bool)
        inside = where < len(self.known)
        new[inside] = self.known[where[inside]] != found[inside]
        at = at[new]
        encode = self.encode
        ids = [encode(text[a:b]) for a, b in zip(first[at].tolist(), stop[at].tolist())]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        base = len(self.ids) + np.cumsum(lengths) - lengths
        slots = np.empty(len(found), np.int64)
        slots[~new] = self.known_slot[where[~new]]
        slots[new] = len(self.length) + np.arange(len(ids))
        self.ids = np.concatenate([self.ids, np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(lengths.sum()))])
        self.length, self.at = np.concatenate([self.length, lengths]), np.concatenate([self.at, base])
        self.known = np.insert(self.known, where[new], found[new])
        self.known_slot = np.insert(self.known_slot, where[new], slots[new])
        return slots[back]

    def _forget(self) -> None:
        self.known, self.known_slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.at, self.length = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if not any(SPECIAL in t for t in texts):
            return self._ordinary(texts)
        split = [t.split(SPECIAL) for t in texts]
        parts = iter(self._ordinary([p for s in split for p in s]))
        mark = np.array([SPECIAL_ID], np.int32)
        return [np.concatenate([x for part in itertools.islice(parts, len(s)) for x in (mark, part)][1:]) for s in split]

    def _ordinary(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, none of which holds the special token."""
        if len(self.known) > 1 << 20:  # bounded memory; parts met again are encoded again
            self._forget()
        sizes = np.array([len(t) for t in texts], np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        whole = "".join(texts)
        if not whole:
            return [np.zeros(0, np.int32) for _ in texts]
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        edge = np.zeros(len(codes) + 1, bool)
        edge[bounds] = True
        first = self.cuts(codes, edge[:-1])
        stop = np.append(first[1:], len(codes))
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _power("up", len(codes)), out=sums[1:])
        hashes = mix64((sums[stop] - sums[first]) * _power("down", len(codes))[first])
        slots = self._slots(hashes, first, stop, whole)
        lengths = self.length[slots]
        ends = np.cumsum(lengths)
        begin = ends - lengths
        flat = self.ids[np.repeat(self.at[slots] - begin, lengths) + np.arange(int(ends[-1]))]
        parts = np.searchsorted(first, bounds)
        upto = np.concatenate([[0], ends])[parts]
        return [flat[a:b] for a, b in zip(upto[:-1], upto[1:])]


def _text_groups(column: pa.Array) -> Iterator[list[str]]:
    """The texts of a batch, some at a time, so that arrays stay small."""
    group, size = [], 0
    for value in pc.fill_null(column, ""):
        text = value.as_py()
        if group and size + len(text) > PIECE_CHARS:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def token_pieces(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end: int = END,
    with_ids: bool = False,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, and the ids if ``with_ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = None
        for batch in batches:
            tokenizer = tokenizer or Tokenizer(path)
            row = 0
            for texts in _text_groups(batch.column(1)):
                docs_, out = [], {c: [] for c in ("piece", "start", "length", "ids_crc32", "ids")}
                for ids in tokenizer.batch(texts):
                    ids = np.append(ids, end).astype("<u4")
                    head = len(ids) % capacity or capacity
                    starts = [0, *range(head, len(ids), capacity)]
                    for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                        docs_.append(row)
                        raw = ids[a:b].tobytes()
                        for c, v in zip(out, (i, a, b - a, zlib.crc32(raw), raw)):
                            out[c].append(v)
                    row += 1
                columns = [
                    batch.column(0).take(pa.array(docs_, pa.int64())),
                    pa.array(out["piece"], pa.int32()),
                    *(pa.array(out[c], pa.int64()) for c in ("start", "length", "ids_crc32")),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(out["ids"], pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, schema)


# A configuration: lengths and how often each occurs.
Configuration = tuple[tuple[int, int], ...]


def knapsack(lengths: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """The largest worth that fits each room from 0 to ``capacity``, by dynamic programming; ``lengths`` ascend."""
    best = np.zeros(capacity + 1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(int(lengths[0]), capacity + 1):
        k = fits[room]
        best[room] = max(best[room - 1], (best[room - lengths[:k]] + worth[:k]).max())
    return best


def best_configuration(
    anchor: int, lengths: np.ndarray, worth: np.ndarray, best: np.ndarray, most: np.ndarray, capacity: int
) -> dict[int, int]:
    """The best way the table knows to fill up a sequence that holds ``anchor``: places of lengths and copies, each at most
    ``most`` times.  Of fillings of equal worth the one with the greatest lengths."""
    counts, room, free = {anchor: 1}, capacity - int(lengths[anchor]), most.copy()
    free[anchor] -= 1
    while k := int(np.searchsorted(lengths, room, side="right")):
        value = np.where(free[:k] > 0, best[room - lengths[:k]] + worth[:k], -1.0)
        i = k - 1 - int(value[::-1].argmax())
        if value[i] < 0:
            break
        copies = np.arange(1, min(int(free[i]), room // int(lengths[i])) + 1)
        worse = best[room - copies * lengths[i]] + copies * worth[i] < value[i] - 1e-12
        take = int(worse.argmax()) if worse.any() else len(copies)
        take = max(take, 1)
        counts[i] = counts.get(i, 0) + take
        free[i] -= take
        room -= take * int(lengths[i])
    return counts


# How often each configuration (places of lengths and copies) is used.
Use = dict[tuple[tuple[int, int], ...], float]


def _cover(lengths: np.ndarray, counts: np.ndarray, worth: np.ndarray, best: np.ndarray, capacity: int) -> tuple[Use, np.ndarray]:
    """Cover all pieces with configurations priced by the table, those of the greatest lengths first, and tell how much the
    configurations of each length fall short of the best one."""
    covered, short = np.zeros(len(lengths)), np.zeros(len(lengths))
    most = np.minimum(counts, capacity // lengths)
    use: Use = {}
    for anchor in range(len(lengths) - 1, -1, -1):
        while most[anchor]:
            config = best_configuration(anchor, lengths, worth, best, most, capacity)
            places, copies = np.fromiter(config, np.int64), np.fromiter(config.values(), np.int64)
            times = float(((counts[places] - covered[places]) / copies).min())
            key = tuple(sorted(config.items(), reverse=True))
            use[key] = use.get(key, 0.0) + times
            covered[places] += times * copies
            short[places] += times * copies * max(0.0, 1 - float(worth[places] @ copies) / best[capacity])
            most[places[counts[places] - covered[places] <= 1e-9 * counts[places]]] = 0
    return use, short / counts


def fractional(lengths: np.ndarray, counts: np.ndarray, capacity: int, steps: int, gap: float = 1e-3) -> tuple[Use, float]:
    """Multiplicative weights: how often each configuration is used, and a lower bound of the number of sequences.

    A step prices lengths by their weights and covers all pieces.  Lengths that end in configurations worth less than
    the knapsack's optimum gain weight, so that later steps give them what fills their sequences.  Weights over that optimum
    are a solution of the dual program, hence the bound.  The best step counts; steps end when it is within ``gap`` of the
    bound, or one sequence.
    """
    worth, bound, kept, least = lengths / capacity, 0.0, {}, np.inf
    for _ in range(steps):
        best = knapsack(lengths, worth, capacity)
        bound = max(bound, float(counts @ worth) / best[capacity])
        use, short = _cover(lengths, counts, worth, best, capacity)
        if sum(use.values()) < least:
            kept, least = use, sum(use.values())
        if least <= bound * (1 + gap) + 1:
            break
        worth = worth * np.exp(short)
    return kept, bound


def best_fit(left: dict[int, int], capacity: int, begun: Iterable[tuple[int, Configuration]] = ()) -> list[tuple[int, Configuration]]:
    """Best fit decreasing on a histogram, also into the room of sequences ``begun``; equal sequences are handled together."""
    open_: dict[int, dict[tuple, int]] = {}  # room -> contents -> how many sequences

    def put(room: int, content: tuple, times: int) -> None:
        if times:
            open_.setdefault(room, {})
            open_[room][content] = open_[room].get(content, 0) + times

    for times, config in begun:
        put(capacity - sum(n * each for n, each in config), config, times)
    for n in sorted(left, reverse=True):
        todo = left[n]
        while todo:
            room = min((r for r in open_ if r >= n and open_[r]), default=None)
            if room is None:
                room, content, have = capacity, (), todo
            else:
                content, have = open_[room].popitem()
            each = room // n
            full = min(have, todo // each)
            put(room - each * n, (*content, (n, each)), full)
            todo -= full * each
            have -= full
            if have and todo and todo < each:
                put(room - todo * n, (*content, (n, todo)), 1)
                todo, have = 0, have - 1
            if content:
                put(room, content, have)
    return [(times, content) for contents in open_.values() for content, times in contents.items()]


class Solution(NamedTuple):
    """Configurations of the rounded program and how many sequences have each, the pieces it leaves, and a lower bound of the
    number of sequences."""

    plan: list[tuple[int, Configuration]]
    left: dict[int, int]
    bound: float


def solve_program(histogram: dict[int, int], capacity: int = CAPACITY, steps: int = 12, phases: int = 4) -> Solution:
    """The configuration program solved and rounded.

    Configurations are taken a whole number of times, rounded up as far as pieces are left, those of the greatest lengths
    first.  Rounding leaves pieces; a program of its own is solved for these, ``phases`` times at most.
    """
    left = {int(n): int(c) for n, c in histogram.items() if c}
    few = sum(left.values()) // 500
    plan: list[tuple[int, Configuration]] = []
    bound = 0.0
    for _ in range(phases):
        if sum(left.values()) <= few or not left:
            break
        lengths = np.array(sorted(left), np.int64)
        rest = [left[n] for n in lengths.tolist()]
        use, below = fractional(lengths, np.array(rest, np.int64), capacity, steps)
        bound = bound or below
        for config, times in sorted(use.items(), key=lambda u: (-u[0][0][0], -u[1], u[0])):
            whole = min([math.ceil(times * (1 - 1e-9)), *(rest[i] // k for i, k in config)])
            if whole:
                plan.append((whole, tuple((int(lengths[i]), k) for i, k in config)))
                for i, k in config:
                    rest[i] -= whole * k
        left = {n: c for n, c in zip(lengths.tolist(), rest) if c}
    return Solution(plan, left, bound)


def solve(histogram: dict[int, int], capacity: int = CAPACITY, steps: int = 12, phases: int = 4) -> list[tuple[int, Configuration]]:
    """Configurations and how many sequences have each; together they hold exactly the histogram."""
    solution = solve_program(histogram, capacity, steps, phases)
    return best_fit(solution.left, capacity, solution.plan)


def _runs(plan: list[tuple[int, Configuration]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """Per length, in the order its pieces are dealt: pieces, pieces per sequence, first sequence, offset."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    base = 0
    for times, config in plan:
        offset = 0
        for n, each in config:
            runs.setdefault(n, []).append((times * each, each, base, offset))
            offset += n * each
        base += times
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY, steps: int = 12) -> DataFrame:
    """Add sequence_id and offset to pieces that have a ``length``."""
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    runs = _runs(solve(histogram, capacity, steps))
    table = [(n, *run) for n in sorted(runs) for run in runs[n]]
    length, count, each, base, offset = (np.array(c, np.int64) for c in zip(*table)) if table else [np.zeros(0, np.int64)] * 5
    first = np.cumsum(count) - count  # pieces are numbered by length, so runs follow each other
    indexed = ordered_index(pieces, ["length", "doc_id", "piece"], "_idx")
    names = [c for c in pieces.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            idx = batch.column("_idx").to_numpy()
            at = np.searchsorted(first, idx, side="right") - 1
            k = idx - first[at]
            columns = [batch.column(c) for c in names]
            columns += [pa.array(base[at] + k // each[at]), pa.array(offset[at] + k % each[at] * length[at])]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return indexed.select(*names, "_idx").mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    return pack(materialize(token_pieces(docs, path, id_col, text_col, capacity), "pieces"), capacity)


def sequences(packed: DataFrame, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (little-endian 32-bit), n_tokens.  Ids must be unique."""
    ids = token_pieces(docs, path, id_col, text_col, capacity, with_ids=True).select("doc_id", "piece", "ids")
    placed = packed.join(ids, ["doc_id", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # bounded by the capacity
    joined = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("n_tokens"))
