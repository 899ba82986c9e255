"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

Two documents link when their sets of five-word shingles have a Jaccard
similarity of at least 0.8.  Documents with equal sets are one class.  Of each
class the smallest shingle hashes are its keys, and a tile holds the classes of one
key and one band of set sizes (a factor of 1.25, so partners lie in the same or
the next band).  In a tile, each class has a bitmap with one bit per hash; bits
that only one side has bound the overlap from above.  The pairs that survive
tie classes to candidate groups; in each group, which is shuffled once, sorted
arrays are intersected exactly.

Why a fixed number of keys loses nothing: of two sets with similarity s, the k
smallest hashes of the union are common with probability s each, and a common one
is a key of both.  With s >= 0.8 and 20 keys, all 20 miss with a chance of
0.2 ** 20 = 1e-14, in the order of a collision of the 64-bit hashes.  Sets of up
to 95 shingles are covered with certainty (20 keys are a whole prefix).

Skew: equal sets are combined before the shuffle; keys with very many classes are
dealt to pairs of blocks; groups with very many classes are dealt to blocks that
all hold the group's leader, and classes that the leader's part does not reach
are compared with every block afterwards.

Defined cases: NULL, empty and blank texts have no shingles and stay alone; with
fewer than five words the whole sequence is one shingle; rows that repeat an id
are compared as they are; a group's component is its smallest non-NULL id; an
empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.skew import skew_join
from ..scratch import materialize
from .common import drop_ids, map_arrow
from .components import components
from .words import mix64, pieces, words

SHINGLE = 5
KEYS = 20
TILE_ROWS = 4096  # classes of one block of a key
GROUP_ROWS = 2048  # classes of one block of a candidate group
SOME_SHINGLES = 1 << 16  # of other sets that one set is compared with at a time
_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit hashes of the shingles of each text."""
    for piece in pieces(texts):
        w = words(piece)
        n = piece.last - piece.first
        bounds = np.searchsorted(w.row, np.arange(n + 1))
        rolled = np.zeros(max(0, len(w.hashes) - size + 1), np.uint64)
        for i in range(size):
            rolled = rolled * _STEP + w.hashes[i : i + len(rolled)]
        rolled = mix64(rolled)
        for r in range(n):
            a, b = bounds[r], bounds[r + 1]
            if b - a >= size:
                yield np.unique(rolled[a : b - size + 1])
            elif b > a:
                h = np.uint64(b - a)
                for x in w.hashes[a:b]:
                    h = mix64(np.array([h], np.uint64) * _STEP + x)[0]
                yield np.array([h], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def band_of(n: int) -> int:
    return int(math.floor(math.log(n) / math.log(1.25) + 1e-9))


def width_of(band: int) -> int:
    """Bits of a bitmap in a band: a power of two, about one to two per shingle."""
    return 1 << max(6, math.ceil((band + 1) * math.log2(1.25)))


def _profile(batch: pa.RecordBatch) -> pa.RecordBatch:
    n, h1, h2, keys, bits = [], [], [], [], []
    for s in shingle_sets(batch.column(1)):
        n.append(len(s))
        with np.errstate(over="ignore"):
            h1.append(np.sum(mix64(s + np.uint64(1)), dtype=np.uint64).view(np.int64) if len(s) else 0)
            h2.append(np.bitwise_xor.reduce(mix64(s ^ _STEP)).view(np.int64) if len(s) else 0)
        keys.append(s[:KEYS].view(np.int64))
        if len(s):
            width = width_of(band_of(len(s)) + 1)
            on = np.zeros(width, np.uint8)
            on[(s >> np.uint64(8)).astype(np.int64) & (width - 1)] = 1
            bits.append(np.packbits(on, bitorder="little").tobytes())
        else:
            bits.append(b"")
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            pa.array(n, pa.int64()),
            pa.array(np.array(h1, np.int64)),
            pa.array(np.array(h2, np.int64)),
            pa.array(keys, pa.list_(pa.int64())),
            pa.array(bits, pa.binary()),
        ],
        names=["doc_id", "n", "h1", "h2", "keys", "bits"],
    )


def profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, set size, 128-bit set hash, keys and bitmap."""
    kind = docs.schema[id_col].dataType.simpleString()
    columns = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return map_arrow(columns, _profile, f"doc_id {kind}, n long, h1 long, h2 long, keys array<long>, bits binary")


def _ones(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


def may_link(bits_a, bits_b, n_a, n_b) -> np.ndarray:
    """False where bits that only one side has rule out similarity 0.8, i.e. an overlap of 4/9 of both sizes."""
    least = -(-4 * (n_a + n_b) // 9)
    return (_ones(bits_a & ~bits_b) <= n_a - least) & (_ones(bits_b & ~bits_a) <= n_b - least)


class _Sets:
    """Union-find over the rows of a task."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (p := up.get(root, root)) != root:
            root = p
        while (p := up.get(x, x)) != root:
            up[x] = root
            x = p
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole runs of the first ``keys`` columns of sorted batches."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(i)[-1].as_py() for i in range(keys)]
        same = np.ones(batch.num_rows, bool)
        for i in range(keys):
            same &= batch.column(i).to_numpy(zero_copy_only=False) == last[i]
        cut = int(np.argmax(same))
        if cut == 0 and rest and any(rest[-1].column(i)[-1].as_py() != last[i] for i in range(keys)):
            yield pa.Table.from_batches(rest)
            rest = [batch]
        elif cut == 0:
            rest.append(batch)
        else:
            rest.append(batch.slice(0, cut))
            yield pa.Table.from_batches(rest)
            rest = [batch.slice(cut)]
    if rest:
        yield pa.Table.from_batches(rest)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the candidate pairs of the tiles of a task tie together, as stars: ``a, b``."""
    sets = _Sets()
    for t in _runs(batches, 3):
        key = [t.column(i).to_numpy() for i in range(3)]
        cid, n, own = t.column("cid").to_numpy(), t.column("n").to_numpy(), t.column("side").to_numpy()
        change = np.ones(len(cid), bool)
        if len(cid) > 1:
            change[1:] = (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1]) | (key[2][1:] != key[2][:-1])
        first = np.flatnonzero(change)
        size = np.diff(np.append(first, len(cid)))
        bits = t.column("bits").combine_chunks()
        offsets = np.frombuffer(bits.buffers()[1], np.int32, len(cid) + 1, bits.offset * 4)
        raw = np.frombuffer(bits.buffers()[2], np.uint8)
        band = key[1]
        out_a: list[int] = []
        out_b: list[int] = []

        def fold(rows: np.ndarray, words_: int) -> np.ndarray:
            """Bitmaps of rows as uint64 words, folded to ``words_``."""
            out = np.zeros((len(rows), words_), np.uint64)
            have = (offsets[rows + 1] - offsets[rows]) // 8
            for h in np.unique(have):
                at = np.flatnonzero(have == h)
                index = offsets[rows[at], None] + np.arange(h * 8)
                full = raw[index].view(np.uint64).reshape(len(at), max(1, h // words_), min(h, words_))
                out[at] = np.bitwise_or.reduce(full, axis=1)
            return out

        # Small tiles: all pairs of all tiles at one distance at a time.
        small = size <= 48
        for b in np.unique(band):
            width = width_of(int(b)) // 64
            tile = first[small & (band[first] == b)]
            count = size[small & (band[first] == b)]
            for gap in range(1, int(count.max()) if len(count) else 0):
                tile, count = tile[count > gap], count[count > gap]
                each = count - gap
                left = np.repeat(tile - np.cumsum(each) + each, each) + np.arange(each.sum())
                right = left + gap
                ok = _allowed(own, n, left, right) & (cid[left] != cid[right])
                left, right = left[ok], right[ok]
                for s in range(0, len(left), 8192):
                    x, y = left[s : s + 8192], right[s : s + 8192]
                    keep = may_link(fold(x, width), fold(y, width), n[x], n[y])
                    out_a += cid[x[keep]].tolist()
                    out_b += cid[y[keep]].tolist()
        for a, b in zip(out_a, out_b):
            sets.join(a, b)
        # Large tiles: row by row, leaving out what is already tied.
        for f, c in zip(first[~small], size[~small]):
            rows = np.arange(f, f + c)
            rows = rows[np.argsort(n[rows], kind="stable")]
            words_ = width_of(int(band[f])) // 64
            maps, m, ids, sides = fold(rows, words_), n[rows], cid[rows], own[rows]
            roots = np.array([sets.find(int(i)) for i in ids])
            for i in range(c - 1):
                stop = int(np.searchsorted(m, m[i] * 5 // 4, side="right"))
                j = np.arange(i + 1, stop)
                j = j[(roots[j] != roots[i]) & ((sides[j] & sides[i]) == 0)]
                while len(j):
                    j = j[may_link(maps[i], maps[j], m[i], m[j])]
                    for k in j:
                        if sets.join(int(ids[i]), int(ids[k])):
                            old, new = max(roots[i], roots[k]), min(roots[i], roots[k])
                            roots[roots == old] = new
                    break
    if sets.up:
        nodes = list(sets.up)
        tops = [sets.find(x) for x in nodes]
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(tops, pa.int64())], names=["a", "b"])


def _allowed(side, n, x, y) -> np.ndarray:
    """Not both guests of the tile, and sizes within the factor."""
    low, high = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
    return ((side[x] & side[y]) == 0) & (5 * low >= 4 * high)


def candidate_pairs(classes: DataFrame, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Pairs of classes (``cid, n, keys, bits``) that tie together all that may link."""
    keys = classes.select("cid", "n", F.explode("keys").alias("key"))
    counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    shared = keys.join(counts, "key")
    blocks = F.ceil(F.col("rows") / tile_rows).cast("int")
    band = F.floor(F.ln("n") / math.log(1.25) + 1e-9).cast("int")
    shared = shared.withColumns({"blocks": blocks, "band": band, "block": F.pmod(F.xxhash64("cid"), blocks).cast("int")})
    # A hot key's classes meet in pairs of blocks; all others have one block.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = shared.withColumn("other", other)
    met = met.withColumn("tile", F.least("block", "other") * F.col("blocks") + F.greatest("block", "other"))
    sides = F.explode(F.array(F.struct(F.col("band").alias("at"), F.lit(0).alias("side")), F.struct((F.col("band") + 1).alias("at"), F.lit(1).alias("side"))))
    placed = met.select("key", "tile", "cid", "n", sides.alias("s")).select("key", F.col("s.at").alias("at"), "tile", "cid", "n", "s.side")
    full = placed.join(classes.select("cid", "bits"), "cid").select("key", "at", "tile", "cid", "n", "side", "bits")
    dealt = full.repartition("key", "at", "tile").sortWithinPartitions("key", "at", "tile", "n", "cid")
    return dealt.mapInArrow(_tiles, "a long, b long")


class _Block:
    """Classes of one block, compared bitmap first, then exactly."""

    def __init__(self, cid: np.ndarray, arrays: list[np.ndarray], guest: np.ndarray) -> None:
        self.n = np.array([len(s) for s in arrays])
        order = np.lexsort((cid, self.n))
        self.cid, self.n, self.guest = cid[order], self.n[order], guest[order]
        self.sets = [arrays[i] for i in order]
        words_ = max(1, (1 << max(6, math.ceil(math.log2(max(2, int(self.n.max())))))) // 64)
        self.maps = np.zeros((len(cid), min(words_, 256)), np.uint64)
        for i, s in enumerate(self.sets):
            width = self.maps.shape[1] * 64
            on = np.zeros(width, np.uint8)
            on[(s >> np.uint64(8)).astype(np.int64) & (width - 1)] = 1
            self.maps[i] = np.packbits(on, bitorder="little").view(np.uint64)

    def links(self, roots: np.ndarray | None = None, between: bool = False) -> list[tuple[int, int]]:
        """A forest of exact links.  ``between``: only links of guests with others."""
        c = len(self.cid)
        roots = np.arange(c) if roots is None else roots
        found = []
        for i in range(c - 1):
            stop = int(np.searchsorted(self.n, self.n[i] * 5 // 4, side="right"))
            j = np.arange(i + 1, stop)
            j = j[roots[j] != roots[i]]
            if between:
                j = j[self.guest[j] | self.guest[i]]
            j = j[may_link(self.maps[i], self.maps[j], self.n[i], self.n[j])]
            while len(j):
                some = max(1, int(np.searchsorted(np.cumsum(self.n[j]), SOME_SHINGLES)))
                for k in j[:some][self.linked(i, j[:some])]:
                    if roots[k] != roots[i]:
                        found.append((int(self.cid[i]), int(self.cid[k])))
                        roots[roots == roots[k]] = roots[i]
                j = j[some:]
                j = j[roots[j] != roots[i]]
        return found

    def linked(self, i: int, j: np.ndarray) -> np.ndarray:
        """Which sets ``j`` link with ``i``: 100 * intersection >= 80 * union."""
        own, n = self.sets[i], self.n[j]
        others = np.concatenate([self.sets[k] for k in j])
        hit = own[np.minimum(np.searchsorted(own, others), len(own) - 1)] == others
        common = np.add.reduceat(hit, np.cumsum(n) - n, dtype=np.int64)
        return 100 * common >= 80 * (len(own) + n - common)


def _stars(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Each class of the links with the smallest one that it reaches, so that few rounds remain for their components."""
    sets = _Sets()
    for a, b in links:
        sets.join(a, b)
    return [(x, sets.find(x)) for x in sets.up]


def _groups(between: bool):
    """Task over rows ``group, block, cid, guest, label, shingles`` sorted by group and block: pairs that links tie.

    ``between``: the links themselves, else stars of what they tie in a block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs(batches, 2):
            key = [t.column(i).to_numpy() for i in range(2)]
            change = np.ones(len(key[0]), bool)
            change[1:] = (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])
            first = np.append(np.flatnonzero(change), len(change))
            cid, label = t.column("cid").to_numpy(), t.column("label").to_numpy()
            guest = t.column("guest").to_numpy(zero_copy_only=False).astype(bool)
            column = t.column("shingles").combine_chunks()
            out: list[tuple[int, int]] = []
            for f, e in zip(first[:-1], first[1:]):
                if e - f < 2:
                    continue
                arrays = [np.frombuffer(column[i].as_buffer(), np.uint64) for i in range(f, e)]
                block = _Block(cid[f:e], arrays, guest[f:e])
                roots = None
                if between:
                    order = np.lexsort((cid[f:e], np.array([len(s) for s in arrays])))
                    roots = np.unique(label[f:e][order], return_inverse=True)[1]
                links = block.links(roots, between)
                out += links if between else _stars(links)
            if out:
                a, b = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _arrays(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = [s.tobytes() for s in shingle_sets(batch.column(1))]
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["cid", "shingles"])


def exact_links(classes: DataFrame, candidates: DataFrame, docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pairs of classes that are tied together by links, and tie all that links do: ``a, b``.

    ``classes`` has one document (``doc``: a hash of its text) of each class.
    """
    group = materialize(components(candidates).select(F.col("node").alias("cid"), F.col("component").alias("group")), "groups")
    # Whole texts of one member of each class in a group, as sorted shingle arrays.
    wanted = group.join(classes.select("cid", "doc"), "cid").select("cid", "doc")
    texts = docs.join(wanted, "doc").dropDuplicates(["cid"]).select("cid", "text")
    arrays = map_arrow(texts, _arrays, "cid long, shingles binary")
    # Only groups of more than one block need a number; a large one is dealt to several tasks by the join.
    size = group.groupBy("group").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > group_rows)
    blocks = F.coalesce(F.ceil(F.col("rows") / group_rows).cast("int"), F.lit(1))
    placed = skew_join(group, materialize(size, "large_groups"), "group", "left").withColumn("blocks", blocks)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    rows = materialize(arrays.join(placed, "cid").select("group", "block", "blocks", "cid", "shingles"), "arrays")
    none = F.lit(None).cast("long")
    # The leader (the smallest class) is in every block of its group.
    leader = rows.filter("cid = group and blocks > 1").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    leader = leader.filter(F.col("block") != F.pmod(F.xxhash64("cid"), F.col("blocks")))
    one = rows.unionByName(leader).select("group", "block", "cid", F.lit(False).alias("guest"), F.lit(0).cast("long").alias("label"), "shingles")
    inside = materialize(
        one.repartition("group", "block").sortWithinPartitions("group", "block", "cid").mapInArrow(_groups(False), "a long, b long"),
        "links",
    )
    split = rows.filter("blocks > 1")
    if split.isEmpty():
        return inside
    # Classes of a split group that its leader does not reach meet every block, as guests.
    label = components(inside).select(F.col("node").alias("cid"), F.col("component").alias("label"))
    marked = split.join(label, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    top = marked.filter("cid = group").select("group", F.col("label").alias("top"))
    marked = materialize(skew_join(marked, materialize(top, "tops"), "group", "inner").withColumn("guest", F.col("label") != F.col("top")), "marked")
    # Guests are dealt in chunks, so that a block never holds more than its own rows and one chunk.
    chunked = marked.filter("guest").groupBy("group").agg(F.ceil(F.count(F.lit(1)) / group_rows).cast("int").alias("chunks"))
    marked = skew_join(marked, materialize(chunked, "chunks"), "group", "inner")
    chunk = F.pmod(F.xxhash64("cid", F.lit(1)), F.col("chunks")).cast("int")
    every_chunk = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    every_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    hosts = marked.withColumn("guest", F.lit(False)).withColumn("chunk", every_chunk)
    guests = marked.filter("guest").withColumn("chunk", chunk).withColumn("at", every_block).withColumn("block", F.col("at")).drop("at")
    met = hosts.unionByName(guests).withColumn("block", F.col("block") * F.col("chunks") + F.col("chunk"))
    met = met.select("group", "block", "cid", "guest", "label", "shingles")
    across = met.repartition("group", "block").sortWithinPartitions("group", "block", "cid").mapInArrow(_groups(True), "a long, b long")
    return inside.unionByName(materialize(across, "links"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tile_rows: int = TILE_ROWS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    hashed = base.withColumn("doc", F.xxhash64("doc_id", "text"))
    kind = docs.schema[id_col].dataType.simpleString()
    shape = f"doc_id {kind}, n long, h1 long, h2 long, keys array<long>, bits binary"
    found = map_arrow(hashed.select("doc_id", "text", "doc"), _profile_doc, shape + ", doc long")
    rows = materialize(found, "profiles")
    # Classes of equal sets; what belongs to the set is the same in all its rows.
    classes = rows.filter("n > 0").groupBy("h1", "n", "h2").agg(
        F.min("doc").alias("doc"), F.min("doc_id").alias("least"), F.first("keys").alias("keys"), F.first("bits").alias("bits")
    )
    classes = materialize(classes.withColumn("cid", F.xxhash64("h1", "h2", "n")), "classes")
    pairs = materialize(candidate_pairs(classes, tile_rows), "pairs")
    links = exact_links(classes, pairs, hashed.select("doc", "text"), group_rows)
    tied = components(links).select(F.col("node").alias("cid"), "component")
    named = classes.select("cid", "least").join(tied, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    named = materialize(named, "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    # Materialised, so that both sides of the join come straight from a shuffle, which can be split.
    least = materialize(least, "least").hint("merge")
    of_class = materialize(named.join(least, "component").select("cid", "component_id"), "class_components")
    known = rows.filter("n > 0").select("doc_id", "n", F.xxhash64("h1", "h2", "n").alias("cid"))
    linked = known.join(of_class, "cid").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def _profile_doc(batch: pa.RecordBatch) -> pa.RecordBatch:
    out = _profile(batch)
    return pa.RecordBatch.from_arrays([*out.columns, batch.column(2)], names=[*out.schema.names, "doc"])


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id.  Rows without an id stay."""
    groups = near_duplicates(docs, id_col, text_col)
    dropped = groups.filter("doc_id <> component_id").select(F.col("doc_id").alias(id_col))
    return drop_ids(docs, materialize(dropped, "near_copies"), id_col)
