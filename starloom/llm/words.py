"""Words of whole Arrow batches as 64-bit hashes, without a Python object per word.

The bytes of the texts are looked at together: a table of 256 entries says which
bytes separate words and how the others are folded; a polynomial hash of each
word then comes from running sums.  Texts are taken in pieces of a few MB, so
memory does not follow the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C55 | 1  # odd, so it has an inverse modulo 2**64
PIECE_BYTES = 2 << 20

# Words are what stands between white space; A-Z become a-z, nothing else changes.
BLANK_SEPARATED = np.arange(256, dtype=np.uint8)
BLANK_SEPARATED[65:91] += 32
BLANK_SEPARATED[[32, *range(9, 14)]] = 0
# Words are runs of letters, digits and non-ASCII characters; A-Z become a-z.
ALPHANUMERIC = np.zeros(256, dtype=np.uint8)
for _run in (range(48, 58), range(97, 123), range(128, 256)):
    ALPHANUMERIC[list(_run)] = list(_run)
ALPHANUMERIC[65:91] = range(97, 123)

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        base = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        steps = np.full(max(n, PIECE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = _powers[kind] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads each bit over all 64."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Piece(NamedTuple):
    """Some whole texts of a batch: rows first..last-1, their bytes, and where each starts."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray  # last - first + 1 offsets into data


def pieces(texts: pa.Array, most: int = PIECE_BYTES, most_rows: int = 1 << 20) -> Iterator[Piece]:
    """Cut a string column into pieces of at most ``most`` bytes and ``most_rows`` texts, longer texts alone.  NULL is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(bounds, bounds[first] + most, side="right")) - 1
        last = min(len(texts), first + most_rows, max(last, first + 1))
        yield Piece(first, last, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first])
        first = last


class Words(NamedTuple):
    hashes: np.ndarray  # uint64, in order
    row: np.ndarray  # row of each word, counted from the piece's first
    start: np.ndarray  # byte offsets
    end: np.ndarray


def words(piece: Piece, fold: np.ndarray = BLANK_SEPARATED) -> Words:
    n = len(piece.data)
    rows = piece.last - piece.first
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, none)
    folded = fold[piece.data]
    inside = folded != 0
    edge = np.zeros(n + 1, bool)  # a text starts here
    edge[piece.bounds] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(folded * _power("up", n), out=sums[1:], dtype=np.uint64)
    hashes = mix64((sums[end] - sums[start]) * _power("down", n)[start])
    per_row = np.diff(np.searchsorted(start, piece.bounds))
    return Words(hashes, np.repeat(np.arange(rows), per_row), start, end)
