"""The capture index against a plain reading of all urls, and archives of pages of very different sizes."""

from __future__ import annotations

import glob
import hashlib
import os
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from starloom.llm import warc


def test_search_finds_what_a_plain_grouping_finds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    long = "http://l.org/" + "y" * 400
    urls = [f"http://h{i % 7}.b.org/p{i % 23}" for i in range(300)] + ["http://hot.org/x y"] * 150 + [long + "a", long + "b", long, None, "", "no url"]
    rows = [(i, u, f"page {i}") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, f"{tmp_path}/a")
    stored = warc.materialize(warc.read_captures(spark, f"{tmp_path}/a"), "captures")
    warc.build_index(stored, f"{tmp_path}/i", lines=4)
    assert spark.read.parquet(f"{tmp_path}/i/directory").count() >= 100
    expected = defaultdict(list)
    for i, u, _ in rows:
        expected[warc.capture_key(u)].append(i)
    for key, ids in expected.items():
        numbers = warc.Directory(spark, f"{tmp_path}/i").blocks(key)
        assert len(numbers) <= len(ids) + 2
    asked = spark.createDataFrame([(k,) for k in [*expected, "org,absent)/", "zz", "a", "a"]], "key string")
    got = defaultdict(list)
    for r in warc.search(asked, f"{tmp_path}/i").collect():
        got[r["key"]].append(r["page_id"])
    assert {k: sorted(v) for k, v in got.items()} == expected
    for url in ("http://hot.org/x y", "http://h3.b.org/p3", long + "b", long, "http://absent.org/"):
        ids = [c["page_id"] for c in warc.lookup(spark, f"{tmp_path}/i", url)]
        assert sorted(ids) == expected.get(warc.capture_key(url), [])
    capture = warc.lookup(spark, f"{tmp_path}/i", long + "a")[0]
    assert warc.read_range(spark, capture) == b"page 450"


def test_rows_come_through_the_index(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://a.org/{i}", f"{i}") for i in range(40)], "page_id long, url string, html string")
    whole = warc.archive(pages, f"{tmp_path}/w")
    assert whole.count() == 40
    part = warc.fetch(warc.search(warc.keys_of(pages.filter("page_id in (3, 17)")), f"{tmp_path}/w/index"))
    got = {r["page_id"]: r["payload_digest"] for r in part.collect()}
    assert got == {i: hashlib.sha1(str(i).encode()).hexdigest() for i in (3, 17)}


def test_large_pages_have_archives_of_few_records(spark, tmp_path):
    sizes = [10] * 200 + [3_000_000] * 6 + [200_000] * 8
    rows = [(i, None if i % 50 == 0 else f"http://a.org/{i}") for i in range(len(sizes))]
    pages = spark.createDataFrame(rows, "page_id long, url string").repartition(1)
    at = F.element_at(F.array(*[F.lit(s) for s in sizes]), F.col("page_id").cast("int") + 1)
    pages = pages.withColumn("html", F.concat(F.repeat(F.lit("é"), (at / 2).cast("int")), F.col("page_id")))
    warc.write_archives(pages, f"{tmp_path}/a", file_bytes=1 << 20)
    files = [os.path.getsize(f) for f in glob.glob(f"{tmp_path}/a/*/part-*")]
    assert max(files) < 3_100_000 and len(files) >= 8
    assert Counter(r["page_id"] for r in warc.read_captures(spark, f"{tmp_path}/a").collect()) == Counter(range(len(sizes)))
    got = {r["page_id"]: r["payload_bytes"] for r in warc.archive(pages, f"{tmp_path}/b").collect()}
    assert got == {i: s + len(str(i)) for i, s in enumerate(sizes)}
