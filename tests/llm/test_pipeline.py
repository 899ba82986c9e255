"""Every stage of the pipeline against brute force on its own input."""

import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np

import corpus_pipeline
from starloom.llm import toxicity
from starloom.llm.common import table, vocabulary
from starloom.llm.oracles import ORACLES

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def counted(rows):
    return Counter(tuple(r) for r in rows)


def by_sql(name, folder):
    """The rows of an operator's SQL over the documents stored in ``folder``."""
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/*.parquet'")
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    return [dict(zip(names, row)) for row in cur.fetchall()]


def plain_margin(model, text):
    """The factorization machine in its textbook form: a loop over terms and pairs of terms."""
    import pyarrow as pa

    from starloom.llm.words import ALPHANUMERIC, pieces, words

    place = {int(t): i for i, t in enumerate(model.terms)}
    found = set()
    for piece in pieces(pa.array([text], pa.string())):
        found |= {place[h] for h in words(piece, ALPHANUMERIC).hashes.tolist() if h in place}
    ones = sorted(found)
    out = model.bias + sum(model.weight[i] for i in ones)
    for k, i in enumerate(ones):
        for j in ones[k + 1 :]:
            out += float(model.factor[i] @ model.factor[j])
    return out


def test_each_stage_against_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "ngram_join", "mixing", "packing"]
    docs = table(spark, SF, "documents")
    assert docs.columns == COLUMNS

    def stored(frame, name):
        path = f"{tmp_path}/{name}"
        frame.write.parquet(path)
        return spark.read.parquet(path), path

    # Toxicity: exactly the documents below the threshold stay.
    now, _ = stored(stages["toxicity"](spark, docs, SF), "toxicity")
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    everything = docs.collect()
    assert counted(now.collect()) == counted(r for r in everything if plain_margin(model, r["text"]) < 0)

    # Exact copies: the rows that the SQL keeps.
    before, path = now, f"{tmp_path}/toxicity"
    now, _ = stored(stages["exact_dedup"](spark, before, SF), "exact_dedup")
    keep = {r["doc_id"] for r in by_sql("op5_exact_dedup", path) if r["kept"]}
    assert counted(now.collect()) == counted(r for r in before.collect() if r["doc_id"] in keep)

    # Near copies: the smallest id of each component.
    before, path = now, f"{tmp_path}/exact_dedup"
    now, _ = stored(stages["ngram_join"](spark, before, SF), "ngram_join")
    keep = {r["doc_id"] for r in by_sql("op1_ngram_join", path) if r["component_id"] == r["doc_id"]}
    assert counted(now.collect()) == counted(r for r in before.collect() if r["doc_id"] in keep)

    # Mixing: every document with words as often as the SQL takes it; the words of a source come near its target.
    before, path = now, f"{tmp_path}/ngram_join"
    now, _ = stored(stages["mixing"](spark, before, SF), "mixing")
    plan = {r["doc_id"]: r for r in by_sql("op2_mixing", path)}
    times = Counter(r["doc_id"] for r in now.collect())
    original = {r["doc_id"]: tuple(r) for r in before.collect()}
    assert all(tuple(r) == original[r["doc_id"]] for r in now.collect())
    for i, r in plan.items():
        if r["size"]:
            assert times[i] == r["taken"] // r["size"], i

    # Packing: all pieces of all rows, gapless sequences, ids as the public tokenizer gives them.
    packed = stages["packing"](spark, now, SF).collect()
    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    want = Counter()
    for r in now.collect():
        ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        head = len(ids) % 2048 or 2048
        starts = [0, *range(head, len(ids), 2048)]
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want[(r["doc_id"], i, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == want
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= sum(r["length"] for r in packed) // 2048 + 2
