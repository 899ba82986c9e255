"""Few rounds for components: edges that are stars already are stored once, and tasks of the near-copy join give stars."""

import numpy as np
import pyarrow as pa

from starloom.llm import components as module
from starloom.llm import ngram_join


def plain(edges):
    """The smallest node that each node reaches."""
    up = {x: x for e in edges for x in e if e[0] != e[1]}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and up[a] != up[b]:
                up[a] = up[b] = min(up[a], up[b])
                changed = True
    return up


def test_rounds_end_as_soon_as_stars_are_left(spark, monkeypatch):
    stored = []
    keep = module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, label: stored.append(label) or keep(df, label))
    random = np.random.default_rng(5)
    cases = [
        ([(1, 5), (6, 1), (1, 5), (2, 3), (9, 9)], 1),  # stars
        ([], 1),
        ([(i, i + 1) for i in range(8)], 7),
        ([tuple(map(int, e)) for e in random.integers(0, 60, (45, 2))], 9),
    ]
    for edges, most in cases:
        stored.clear()
        got = module.components(spark.createDataFrame(edges, "a long, b long")).collect()
        assert {r["node"]: r["component"] for r in got} == plain(edges)
        assert len(got) == len(plain(edges))
        assert len(stored) <= most, (edges, stored)


def test_links_of_a_block_come_as_stars_and_match_brute_force():
    random = np.random.default_rng(7)
    base = [np.unique(random.integers(0, 1 << 62, n).astype(np.uint64)) for n in (1, 5, 60, 61, 40_000)]
    arrays = []
    for b in base:
        for lost in (0, 0.05, 0.1, 0.2, 0.3):
            arrays.append(b[random.random(len(b)) >= lost] if lost else b)
    arrays = [a for a in arrays if len(a)]
    cid = random.permutation(len(arrays))
    pairs = [(i, j) for i in range(len(arrays)) for j in range(i)]
    sets = [set(a.tolist()) for a in arrays]
    links = [(int(cid[i]), int(cid[j])) for i, j in pairs if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    batch = pa.RecordBatch.from_pydict({
        "group": np.zeros(len(cid), np.int64), "block": np.zeros(len(cid), np.int32), "cid": cid, "guest": np.zeros(len(cid), bool),
        "label": cid, "shingles": [a.tobytes() for a in arrays],
    })
    out = [r for b in ngram_join._groups(False)(iter([batch])) for r in zip(*(c.to_pylist() for c in b.columns))]
    assert sorted(out) == sorted((x, low) for x, low in plain(links).items() if x != low)
