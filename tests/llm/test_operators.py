"""The operators against brute force, and their defined results for awkward input."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import ann, exact_dedup, html_extract, langid, mixing, ngram_join, packing, quality, toxicity, warc
from starloom.llm.common import table, vocabulary
from starloom.llm.components import components

from .conftest import TEXTS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def shingles(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_exact_groups(docs, none):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t, _ in TEXTS]
    ids = defaultdict(list)
    for i, t in norm:
        ids[t].append(i)
    want = Counter()
    for i, t in norm:
        keep = min((x for x in ids[t] if x is not None), default=None)
        want[(i, keep, len(ids[t]), i == keep)] += 1
    for least in (64, 2):  # 2: all groups go the way of the heavy ones
        got = exact_dedup.exact_groups(docs, least=least).drop("text_sha256").collect()
        assert Counter(map(tuple, got)) == want
    assert exact_dedup.exact_groups(none).count() == 0
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    stay = sorted((r["doc_id"] or -1) for r in kept.collect())
    assert stay == [-1, 1, 2, 3, 5, 7, 8, 9, 10, 12]


@pytest.mark.parametrize("sizes", [(4096, 2048), (2, 2)])
def test_near_duplicates(docs, none, sizes):
    got = Counter(map(tuple, ngram_join.near_duplicates(docs, tile_rows=sizes[0], group_rows=sizes[1]).collect()))
    sets = [(i, shingles(t)) for i, t, _ in TEXTS]
    up = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                old, new = up[a], up[b]
                up = [new if u == old else u for u in up]
    want = Counter()
    for (i, s), u in zip(sets, up):
        least = min((j for (j, _), v in zip(sets, up) if v == u and j is not None), default=None)
        want[(i, len(s), least if s else i)] += 1
    assert got == want
    assert ngram_join.near_duplicates(none).count() == 0
    kept = ngram_join.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} >= {1, 5, 6, 7, 8, 10, 12, None}


def test_a_large_group_is_split_and_stays_whole(spark):
    """A chain of near copies that the leader reaches only in part."""
    words = [f"c{i}" for i in range(200)]
    rows = []
    for i in range(60):
        mine = list(words)
        for k in range(i):
            mine[(k * 3) % 200] = f"z{k}"
        rows.append((i, " ".join(mine)))
    found = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), tile_rows=5, group_rows=4)
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}
    for a in sets:
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(up[a], up[b]), min(up[a], up[b])
                up = {k: new if v == old else v for k, v in up.items()}
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == up


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 300), (300, 200), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 200: 100, 300: 100}


def test_mixing(docs, none, spark):
    placed = mixing.with_places(docs)
    plan = mixing.plan_mix(placed, block_words=50, shard_words=1000)
    runs = [sorted((r["doc_id"] or 0, r["_size"], r["_target"], [tuple(d) for d in r["_draws"]]) for r in mixing.draw(placed, plan).collect()) for _ in range(2)]
    assert runs[0] == runs[1]
    assert all(len(r[3]) <= 3 for r in runs[0])
    assert len({d[1] for r in runs[0] for d in r[3]}) > 1
    total = sum(len(WORD.findall(t or "")) for _, t, _ in TEXTS)
    assert math.isclose(sum(r["target"] for r in plan.collect()), total)
    assert all(r["target"] <= 3 * r["words"] + 1e-9 for r in plan.collect())
    assert mixing.mix(docs, shard_words=1000).columns == docs.columns
    assert mixing.mix(none).count() == 0


def test_quotas_are_dealt_exactly_and_without_bias(spark):
    rows = spark.range(400).select(F.concat(F.lit("s"), "id").alias("seed"))
    drawn = rows.select(
        mixing._draw(F.lit([30, 10, 60]).cast("array<long>"), F.lit(50).cast("long"), F.col("seed")).alias("x")
    ).collect()
    x = np.array([r["x"] for r in drawn])
    assert (x.sum(axis=1) == 50).all()
    assert np.allclose(x.mean(axis=0), [15, 5, 30], atol=0.6)
    variance = 50 * 0.3 * 0.7 * 50 / 99
    assert 0.75 * variance < x[:, 0].var() < 1.3 * variance
    quotas = spark.createDataFrame([("a", 1001), ("b", 17), ("c", 0)], "_key string, quota long")
    parts = mixing.deal(quotas, 7).collect()
    assert {r["shard"] for r in parts} == set(range(7)) and all(r["n"] > 0 for r in parts)
    assert [sum(r["n"] for r in parts if r["_key"] == k) for k in "abc"] == [1001, 17, 0]
    assert sorted(sum(r["n"] for r in parts if r["shard"] == i) for i in range(7)) == [145] * 4 + [146] * 3


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 50), st.integers(1, 500)), min_size=1, max_size=20))
def test_solved_packing_holds_the_histogram(items):
    histogram = Counter()
    for n, c in items:
        histogram[n] += c
    plan = packing.solve(dict(histogram), 50, steps=10)
    back = Counter()
    for times, config in plan:
        assert sum(n * a for n, a in config) <= 50
        for n, a in config:
            back[n] += a * times
    assert back == histogram
    assert sum(t for t, _ in plan) <= 1.1 * sum(t for t, _ in packing.best_fit(dict(histogram), 50)) + 5


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sStmdrevl1é中😀-.! \x85"), st.characters(exclude_categories=("Cs",))), max_size=40), max_size=6))
def test_token_ids_are_those_of_the_public_tokenizer(texts):
    from tokenizers import Tokenizer

    mine, theirs = _TOKENIZERS.setdefault("mine", None), _TOKENIZERS.setdefault("theirs", None)
    if mine is None:
        mine = _TOKENIZERS["mine"] = packing.Tokenizer(vocabulary(packing.VOCABULARY))
        theirs = _TOKENIZERS["theirs"] = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
        theirs.encode_special_tokens = True
    for t, ids in zip(texts, mine.batch(texts)):
        assert ids.tolist() == theirs.encode(t, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([packing.SPECIAL, packing.SPECIAL[:-1], "<|", " ", "  ", "\n", "a", " b's", "é1", "."]), max_size=8).map("".join), max_size=5))
def test_special_token_inside_a_text_is_that_token(texts):
    from tokenizers import Tokenizer

    if "contract" not in _TOKENIZERS:
        _TOKENIZERS["contract"] = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
        _TOKENIZERS["own"] = packing.Tokenizer(vocabulary(packing.VOCABULARY))
    for t, ids in zip(texts, _TOKENIZERS["own"].batch(texts)):
        assert ids.tolist() == _TOKENIZERS["contract"].encode(t, add_special_tokens=False).ids


_TOKENIZERS = {}


def test_packing(docs, none, spark):
    from tokenizers import Tokenizer

    path = vocabulary(packing.VOCABULARY)
    theirs = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    packed = packing.pack_documents(docs, path, capacity=256)
    rows = packed.collect()
    for i, t, _ in TEXTS[:11]:
        ids = np.array(theirs.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine)))
        assert sum(r["length"] for r in mine) == len(ids) and all(r["length"] == 256 for r in mine[1:])
        for r in mine:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    filled = defaultdict(list)
    for r in rows:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(filled) <= math.ceil(sum(r["length"] for r in rows) / 256) + 2
    assert packing.pack_documents(none, path).count() == 0
    few = docs.filter("doc_id < 10")
    whole = packing.sequences(packing.pack_documents(few, path, capacity=256), few, path, capacity=256).collect()
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in whole)


def held_out(spark, scored, label):
    rows = scored.join(table(spark, "/root/testdata/sf0.1", "labels"), "doc_id").filter("held_out").select("score", "predicted", label).collect()
    return [(r[0], r[1], r[2]) for r in rows]


def test_toxicity(docs, none, spark):
    sf = "/root/testdata/sf0.1"
    model = toxicity.fit(table(spark, sf, "documents"), table(spark, sf, "labels"))
    found = held_out(spark, toxicity.score(table(spark, sf, "documents"), model), "toxic")
    assert sum(p == y for _, p, y in found) / len(found) > 0.95
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows if r["doc_id"] in (5, 6, 7)} == {float(toxicity.sigmoid(np.array([model.bias]))[0])}
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() <= len(TEXTS)
    no_labels = table(spark, sf, "labels").limit(0)
    empty = toxicity.fit(docs, no_labels)
    assert toxicity.score(docs, empty).filter("predicted = 1").isEmpty()
    assert toxicity.score(none, empty).isEmpty()


def test_only_near_copies_of_one_label_count_once(spark, monkeypatch):
    rows = [(i, "plain words " + " ".join(f"u{i}x{k}" for k in range(8)), i % 2) for i in range(100)]
    long = " ".join(f"z{k}" for k in range(40))
    # A copy, a near copy (38 of 42 terms), a text half alike, and a copy of the other label.
    alike = [(long, 1), (long, 1), (long.replace("z3 ", "y3 ").replace("z4 ", "y4 "), 1), (long[: len(long) // 2], 1), (long, 0)]
    ids = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % toxicity.FOLDS][: len(alike)]
    rows += [(i, *a) for i, a in zip(ids, alike)]
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda *a: seen.append([x.tolist() if hasattr(x, "tolist") else x for x in a]))
    for parts in (1, 7):
        frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(parts)
        toxicity.fit(frame.drop("toxic"), frame.drop("text"))
    want = Counter(float(y) for i, _, y in rows[:100] if zlib.crc32(str(i).encode()) % toxicity.FOLDS) + Counter([1.0, 1.0, 0.0])
    assert Counter(seen[0][2]) == want
    assert seen[0] == seen[1]  # also in the same order


def test_language(docs, none, spark):
    sf = table(spark, "/root/testdata/sf0.01", "documents")
    model = langid.fit(sf)
    found = langid.identify(sf, model).join(sf.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) / len(found) > 0.97
    rows = langid.identify(docs, model).collect()
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["doc_id"] in (5, 6, 7))
    assert all(r["lang_pred"] in model.names and 0 <= r["score"] <= 1 for r in rows if r["doc_id"] == 10)
    assert {r["lang_pred"] for r in langid.identify(docs, langid.fit(none)).collect()} == {"und"}


def test_quality(docs, none, spark):
    sf = "/root/testdata/sf0.1"
    stats = quality.document_statistics(table(spark, sf, "documents"))
    labels = table(spark, sf, "labels")
    model = quality.fit(stats, labels)
    found = held_out(spark, quality.score(stats, model), "quality")
    assert sum(p == y for _, p, y in found) / len(found) > 0.97
    rows = quality.score(quality.document_statistics(docs), model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.fit(stats, labels.limit(0)) == 0.0
    assert quality.score(quality.document_statistics(none), 0.0).isEmpty()


def test_nearest(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 8)).astype("float32")
    x[50:90] = x[50]  # many copies
    rows = [(i, [float(v) for v in r], 0, "c") for i, r in enumerate(x)]
    rows += [(400, None, 0, "c"), (420, [0.0] * 8, 0, "c"), (440, [float("nan")] * 8, 0, "c"), (460, [1.0] * 3, 0, "c"), (480, [None] * 8, 0, "c")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell int, v string")
    got = defaultdict(list)
    for r in sorted(ann.nearest(frame, 20, bucket=64).collect(), key=lambda r: r["rank"]):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 400, 20))
    y, hits = x.astype(float), 0
    for q, found in got.items():
        score = y @ y[q]
        order = sorted((i for i in range(400) if i != q), key=lambda i: (-score[i], i))[:20]
        hits += len(set(order) & {i for i, _ in found})
        assert len(found) == 20 and all(math.isclose(s, score[i], abs_tol=1e-12) for i, s in found)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
    assert hits >= 0.9 * 20 * len(got)
    assert ann.nearest(frame.limit(0), 20).isEmpty()
    assert ann.nearest(frame.filter("vec_id < 3"), 2).count() == 4


def test_archives(spark, tmp_path):
    big = "<p>é " + "x" * 1200
    rows = [(1, "http://a.b.org/x?q#f", big, 0), (2, "http://a.b.org/x?q", big, 0), (3, None, None, 0), (4, "bad url\r\n", "", 0)]
    rows += [(5, "https://c.org", "small\r\n\r\nWARC/1.1\r\n", 0), (6, "https://c.org", "small\r\n\r\nWARC/1.1\r\n", 0), (7, "http://a.b.org/y", big + "y", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    got = {r["page_id"]: r for r in warc.archive(pages, str(tmp_path)).collect()}
    import hashlib

    for i, _, html, _ in rows:
        data = (html or "").encode()
        assert got[i]["payload_bytes"] == len(data) and got[i]["payload_digest"] == hashlib.sha1(data).hexdigest()
        assert (got[i]["record_type"], got[i]["refers_to"]) == (("revisit", 2) if i == 1 else ("response", None))
    found = warc.lookup(spark, f"{tmp_path}/index", "http://a.b.org/x?q")
    assert [c["page_id"] for c in found] == [1, 2]
    assert warc.read_range(spark, found[1]) == big.encode()
    assert warc.lookup(spark, f"{tmp_path}/index", "http://nowhere.org/") == []
    assert warc.archive(pages.limit(0), str(tmp_path / "none")).isEmpty()


def test_main_text(spark):
    page = (
        "<html><head><title>T</title><script>var a='<p>no</p>'</script></head><body><nav><ul><li>menu</ul></nav>"
        "<div class='cookie-notice'>cookies</div><article><header><h1>Head &amp; line</h1></header><p>One\n two<b>x</b>y&nbsp;z<br>w"
        "<p>Second<div class=\"comments\"><p>reader</p></div></article><footer>foot</footer></body></html>"
    )
    plain = "<div>boiler</div><div>own {}</div><form>f</form><!-- c --><p>tail &lt;b&gt;"
    rows = [(1, "http://h/1", page), (2, None, None), (3, "http://h/3", "")]
    rows += [(10 + i, f"http://g.org/{i}", plain.format(i)) for i in range(8)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "host": F.lit(2)})
    got = {r["page_id"]: r for r in html_extract.extract(frame).collect()}
    assert got[1]["text"] == "Head & line\n\nOne twoxy z w\n\nSecond"
    assert (got[2]["text"], got[3]["text"], got[3]["n_chars"]) == ("", "", 0)
    assert got[12]["text"] == "own 2"  # the same blocks on all pages of a host are its template
    assert html_extract.extract(frame.limit(0)).isEmpty()


def test_copies_of_a_page_are_no_template(spark):
    rows = [(i, f"http://copies.org/{i}", "<div>own text</div><div>more</div>") for i in range(8)]
    rows += [(20, "http://copies.org/20", "<div>another page</div>")] * 8
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert Counter(r["text"] for r in got) == {"own text\n\nmore": 8, "another page": 8}


def test_names_alone_lose_no_article():
    def main_text(page):
        return [text for _, text, out, main in html_extract.page_blocks(page) if text and main and not out]

    def rest(page):
        return [text for _, text, out, _ in html_extract.page_blocks(page) if text and not out]

    for tag in (
        "article class='post alert'", "article id='comment-policy'", "main class='sidebar'", "div role='main' class='widget'",
    ):
        assert main_text(f"<body><{tag}><p>own</p></{tag.split()[0]}></body>") == ["own"]
    for mark in ("content with-sidebar", "no-sidebar", "side-by-side", "sidebar", "page-wrapper left-sidebar", "modal overlay"):
        assert main_text(f"<div class='{mark}'><div><article><p>own</p></article></div></div>") == ["own"]
    for mark in ("content with-sidebar", "no-sidebar", "side-by-side", "related-work", "comment-policy", "no_menu"):
        assert rest(f"<section id='{mark}'><p>own</p></section>") == ["own"]
        assert main_text(f"<article><section class='{mark}'><p>own</p></section></article>") == ["own"]
    for mark in ("ad", "post comments", "cookie-notice", "cookie_consent-banner", "comment-list", "main-nav", "site-header", "share"):
        assert rest(f"<div class='{mark}'><p>no</p></div><p>own</p>") == ["own"]
        assert main_text(f"<article><p>own</p><div id='{mark.split()[-1]}'>no</div></article>") == ["own"]
    # An article inside another one is a comment there, not the article.
    assert main_text("<article><p>own</p><div class='comments'><article>reader</article></div></article>") == ["own"]
    # What stands beside the article in a wrapper is judged by its own name.
    page = "<div class='sidebar'><div class='ad'>no</div><article>own</article><div class='related'>no</div></div>"
    assert rest(page) == ["own"]


def test_pipeline(spark, tmp_path, docs):
    for name, frame in (("documents", docs), ("labels", table(spark, SF, "labels"))):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
    assert now.count() > 0
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).isEmpty(), name
