"""Filter audit, fingerprints and fill-in-the-middle against brute force, and their defined results for awkward input."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import SALTED
from hypothesis import given, settings, strategies as st

from check import rows_of
from starloom.limits import Limits
from starloom.llm import filter_audit, fim, simhash
from starloom.llm.common import table
from starloom.llm.oracles import ORACLES
from starloom.llm.queries import QUERIES

from .conftest import TEXTS

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", ["op11_filter_audit", "op13_fim"])
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    cur = con.execute(ORACLES[name])
    df = QUERIES[name](spark, SF)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cur.fetchall())


# -- filter audit -----------------------------------------------------------------


def fails(text):
    words = WORD.findall(text)
    return {
        f
        for f, failed in {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(set(text) & set("#$%&*|")),
        }.items()
        if failed
    }


def plain_audit(docs, labels):
    """``docs``: (id, text, part); ``labels``: (id, quality, toxic)."""
    ids = defaultdict(list)
    for i, t, _ in docs:
        if i is not None:
            ids[t or ""].append(i)
    kinds = []
    for i, t, part in docs:
        bad = fails(t or "")
        if i is not None and i > min(ids[t or ""]):
            bad.add("E")
        good, toxic = (any(i is not None and x[0] == i and x[k] == 1 for x in labels) for k in (1, 2))
        kinds.append((part or "", bad, good, toxic))
    out = {}
    for part in {k[0] for k in kinds}:
        mine = [k[1:] for k in kinds if k[0] == part]
        total = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone, left = [k for k in left if f in k[0]], [k for k in left if f not in k[0]]
                total[f] += len(gone)
                failing = sum(f in k[0] for k in mine)
                out[part, order, step] = [len(left), len(gone), failing - len(gone), sum(k[0] == {f} for k in mine),
                                          sum(k[1] for k in gone), sum(k[2] for k in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize("limits", [Limits(), SALTED], ids=["default", "salted"])
def test_audit_against_brute_force(spark, limits):
    many = " ".join(f"w{i}" for i in range(120))
    texts = [many, many, many, many + " $", "SHOUTING " * 130, "", None, "a b c", "a b c", "ÉÀ ok", many + "\t", "x|y Z"]
    docs = [(i if i != 9 else None, t, [None, "", "en", "de"][i % 4]) for i, t in enumerate(texts)]
    docs += [(1, many, "en"), (None, many, "en"), (None, many, "en"), (20, many.replace(" ", "  "), "de"), (21, many, "de")]
    labels = [(0, 1, 0), (1, 1, 1), (1, 0, 0), (4, None, 1), (None, 1, 1), (21, 1, 1), (7, 0, 0), (3, 1, None), (99, 1, 1)]
    frame = spark.createDataFrame([(*d, "q", 7, True) for d in docs], "doc_id long, text string, lang string, part string, mask int, good boolean")
    marks = spark.createDataFrame([(*x, "d") for x in labels], "doc_id long, quality int, toxic int, digest string")
    got = filter_audit.audit(frame.repartition(3), marks, limits=limits).collect()
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in got} == plain_audit(docs, labels)
    assert len(got) == 600 * 3
    assert filter_audit.audit(frame.limit(0), marks).count() == 0
    unlabelled = filter_audit.audit(frame, marks.limit(0)).collect()
    assert sum(r["good_lost"] + r["toxic_lost"] for r in unlabelled) == 0


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.tuples(st.integers(0, 31), st.booleans(), st.booleans()), st.integers(1, 1 << 58), min_size=1, max_size=8))
def test_packed_counters_do_not_overflow(kinds):
    counts = filter_audit.unpacked(sum(filter_audit.packed(*k) * n for k, n in kinds.items()))
    for i in (0, 7, 311, 599):
        order, step = filter_audit.STEPS[i]
        bits = [1 << "ABCDE".index(f) for f in order]
        here = {k: n for k, n in kinds.items() if k[0] & bits[step] and not k[0] & sum(bits[:step])}
        assert counts[i, 1] == sum(here.values())
        assert counts[i, 4] == sum(n for k, n in here.items() if k[1])
        assert counts[i, 0] == sum(n for k, n in kinds.items() if not k[0] & sum(bits[: step + 1]))


# -- fingerprints -----------------------------------------------------------------


def plain_print(text):
    """One text, one term and one bit after the other; the hashes of words come from the library."""
    from starloom.llm.words import mix64, pieces, words

    hashes = [int(h) for p in pieces(pa.array([text], pa.large_string())) for h in words(p).hashes]
    mix = lambda x: int(mix64(np.array([x % (1 << 64)], np.uint64))[0])
    odd = 0x9E3779B97F4A7C15
    terms = Counter(hashes + [mix(a * odd + b) for a, b in zip(hashes, hashes[1:])])
    votes = [0] * simhash.BITS
    for h, n in terms.items():
        for bit in range(simhash.BITS):
            up = mix(h + bit // 64 * odd) >> bit % 64 & 1
            votes[bit] += (2 * up - 1) * round(8 * (1 + math.log(n)))
    return [sum((votes[64 * w + b] > 0) << b for b in range(64)) for w in range(simhash.BITS // 64)]


def plain_documents(docs):
    """One (id, text) per id, in descending order, NULL last."""
    best = {}
    for i, t in docs:
        best[i] = max(best.get(i, ""), t or "")
    return sorted(best.items(), key=lambda d: (d[0] is not None, d[0] or 0), reverse=True)


def check_prints(got, docs, radius, prints=None):
    ordered = plain_documents(docs)
    texts = [t for _, t in ordered]
    prints = prints or (lambda xs: simhash.fingerprints(pa.array(xs, pa.large_string())))
    own = prints(texts)
    new = [t[: len(t) - len(t) // 2] + texts[(k + 1) % len(texts)][: len(t) // 2] for k, t in enumerate(texts)]
    after = prints(new)
    assert len(got) == len(ordered)
    by_id = {r["doc_id"]: r for r in got}
    for k, (i, t) in enumerate(ordered):
        r, following = by_id[i], own[(k + 1) % len(own)]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(new[k].encode()).hexdigest())
        assert r["fingerprint"] == "".join(f"{int(w):016x}" for w in own[k])
        assert r["edited_fingerprint"] == "".join(f"{int(w):016x}" for w in after[k])
        like = lambda a, b: max(0, math.cos(math.pi * sum((int(x) ^ int(y)).bit_count() for x, y in zip(a, b)) / simhash.BITS))
        assert math.isclose(r["near_edited"], like(own[k], after[k]), abs_tol=1e-9)
        assert math.isclose(r["near_next"], like(own[k], following), abs_tol=1e-9)
        near = (simhash.distances(own, own[k]) <= radius).sum() - 1
        assert r["n_near"] == near


@pytest.mark.parametrize("limits", [Limits(), SALTED], ids=["default", "salted"])
def test_fingerprints_of_awkward_documents(spark, docs, none, limits):
    plain = lambda xs: np.array([plain_print(t) for t in xs], np.uint64)
    short = [(i, t[:600] if t else t) for i, t, _ in TEXTS]
    got = simhash.fingerprint_documents(spark.createDataFrame(short, "doc_id int, text string"), limits=limits)
    assert got.schema["doc_id"].dataType.simpleString() == "int"
    check_prints(got.collect(), short, simhash.RADIUS, plain)
    check_prints(simhash.fingerprint_documents(docs, limits=limits).collect(), [(i, t) for i, t, _ in TEXTS], simhash.RADIUS)
    assert simhash.fingerprint_documents(none).count() == 0
    lone = simhash.fingerprint_documents(docs.filter("doc_id = 9")).collect()
    check_prints(lone, [(9, "One  two")], simhash.RADIUS)


def test_fingerprints_of_the_whole_table(spark, monkeypatch):
    monkeypatch.setattr(simhash, "RANGE_ROWS", 7)  # many ranges of ids
    docs = table(spark, SF, "documents")
    got = simhash.fingerprint_documents(docs).collect()
    check_prints(got, [tuple(r) for r in docs.select("doc_id", "text").collect()], simhash.RADIUS)
    assert np.mean([r["near_edited"] > r["near_next"] for r in got]) > 0.95


@pytest.mark.parametrize("limits", [Limits(), SALTED], ids=["default", "salted"])
@pytest.mark.parametrize("radius, blocks", [(6, 8), (3, 4), (0, 2), (13, 16)])
def test_all_fingerprints_within_the_radius(spark, limits, radius, blocks):
    """Clusters around a few centres, so some keys are shared by many fingerprints that lie apart."""
    if (blocks - radius) * simhash.BITS // blocks > 48:
        with pytest.raises(ValueError, match="48 bits"):
            simhash._tables(radius, blocks)
        return
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 64, (4, 2), dtype=np.uint64)
    prints = []
    for k in range(160):
        p = [int(x) for x in centres[k % 4]]
        for bit in rng.choice(simhash.BITS, rng.integers(0, 9), replace=False).tolist():
            p[bit // 64] ^= 1 << bit % 64
        prints.append(tuple(p))
    some = [p for k, p in enumerate(prints) if p not in prints[:k]]
    signed = [tuple(x - (x >> 63 << 64) for x in p) for p in some]
    frame = spark.createDataFrame([(*p, k % 3 + 1) for k, p in enumerate(signed)], "hi long, lo long, copies long")
    got = {(r["hi"], r["lo"]): r["near"] for r in simhash.neighbours(frame, radius, blocks, limits).collect()}
    want = {}
    for k, p in enumerate(some):
        n = sum(j % 3 + 1 for j, q in enumerate(some) if j != k and sum((x ^ y).bit_count() for x, y in zip(p, q)) <= radius)
        if n:
            want[signed[k]] = n
    assert got == want


# -- fill in the middle --------------------------------------------------------------


def plain_fim(i, text):
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    digest = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return i, len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return i, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_the_middle(spark, docs, none):
    odd = ["a <P> b", "<M>", "tail  ", "\n\n", " x", "𝒳 é y $1 \\2", "<P", "S> <S", "a\r\nb\x0b\x0cc\x1fd\x85e", "w " * 30_000, " " * 5000 + "x", "x" * 300_000]
    texts = [(i, t) for i, t, _ in TEXTS] + [(100 + k, odd[k % len(odd)]) for k in range(40 * len(odd))]
    rows = fim.transform(spark.createDataFrame(texts, "doc_id long, text string"))
    got = rows.withColumn("restored", fim.restore(rows["output"], rows["form"])).collect()
    assert Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in got) == Counter(
        plain_fim(*t) for t in texts
    )
    assert all(r["restored"] == r["text"] for r in got)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fim.transform(none).count() == 0
    assert fim.transform(docs).count() == docs.count()
    assert {r["form"] for r in fim.transform(docs, percent=0).collect()} == {"plain"}
    assert {r["form"] for r in fim.transform(docs, percent=100, spm_percent=0).collect()} == {"plain", "psm"}
