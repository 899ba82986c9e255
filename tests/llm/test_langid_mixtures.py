"""Language mixtures: any number of languages, little evidence, and a slow version in plain Python."""

import math
from collections import Counter

import numpy as np
import pytest

from starloom.llm import langid
from starloom.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="module")
def model(docs):
    return langid.fit(docs)


def predicted(spark, model, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r["lang_pred"], r["score"]) for r in langid.identify(rows, model).orderBy("doc_id").collect()]


def plain_trigrams(text):
    """Counts per bucket, byte by byte."""
    data = [32, *(langid.LETTERS[b] for b in text.encode()), 32]
    found = Counter()
    for a, b, c in zip(data, data[1:], data[2:]):
        if b != 32 or (a != 32 and c != 32):
            code = int(a) << 16 | int(b) << 8 | int(c)
            found[(code * 0x9E3779B1 & 0xFFFFFFFF) >> 20] += 1
    return found


def plain_mixture(model, text):
    counts, k = plain_trigrams(text), len(model.names)
    p = model.p.astype(float)
    total = max(1, sum(counts.values()))

    def fit(w):
        for _ in range(langid.ROUNDS):
            new = [0.0] * k
            for bucket, n in counts.items():
                mix = sum(w[i] * p[i, bucket] for i in range(k))
                for i in range(k):
                    new[i] += n * w[i] * p[i, bucket] / mix
            w = [x / sum(new) for x in new] if sum(new) else [1 / k] * k
        return w

    def likelihood(w):
        return sum(n * math.log(sum(w[i] * p[i, b] for i in range(k))) for b, n in counts.items()) / 3

    single = [likelihood([float(i == j) for i in range(k)]) for j in range(k)]
    posterior = [s + math.log(q) for s, q in zip(single, model.share)]
    posterior = [math.exp(x - max(posterior)) for x in posterior]
    best = (max(single), int(np.argmax(posterior)), max(posterior) / sum(posterior))
    if not counts:
        return best[1:]
    free = fit([1 / k] * k)
    order = sorted(range(k), key=lambda i: -free[i])
    for size in range(2, k + 1):
        if free[order[size - 1]] <= langid.LEAST_WEIGHT:
            break
        start = [free[i] + 1e-3 if i in order[:size] else 0.0 for i in range(k)]
        w = fit([x / sum(start) for x in start])
        value = likelihood(w) - (size - 1) * 0.5 * math.log(total + 1)
        if value > best[0]:
            best = (value, int(np.argmax(w)), max(w))
    return best[1:]


def test_whole_table_against_plain_em(docs, model):
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    assert len(got) == len(texts)
    for i, text in texts.items():
        if got[i]["lang_pred"] == langid.UNKNOWN:
            continue
        place, share = plain_mixture(model, text)
        assert math.isclose(got[i]["score"], share, abs_tol=2e-3), (i, got[i], share)
        assert got[i]["lang_pred"] == model.names[place]


def test_four_languages_in_equal_parts(spark, docs, model):
    rows = docs.filter("lang is not null and length(text) > 1500").select("lang", "text").collect()
    parts = {}
    for lang, text in rows:
        parts.setdefault(lang, text)
    assert len(parts) == 4
    size = 1400
    mixed = " ".join(t[:size] for t in parts.values())
    one, two = parts["en"][:size], " ".join(parts[n][:size] for n in ("de", "fr"))
    (_, four), (name, alone), (_, half) = predicted(spark, model, [mixed, one, two])
    assert abs(four - 0.25) < 0.05 and abs(half - 0.5) < 0.06
    assert name == "en" and alone > 0.99


def test_little_evidence_is_not_certain(spark, model):
    got = predicted(spark, model, ["a", "ok", "é", "x1", "", None, "12 34", "…", "я"])
    assert all(score < 0.999 for _, score in got)
    assert [lang for lang, _ in got[4:8]] == ["und"] * 4
    assert all(lang in model.names for lang, _ in got[:4])


def test_no_trigram_gives_the_learned_share(model):
    best, share = model.mixtures(np.zeros((2, langid.BUCKETS), np.float32))
    assert best.tolist() == [int(model.share.argmax())] * 2
    assert np.allclose(share, model.share.max())
