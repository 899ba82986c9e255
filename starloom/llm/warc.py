"""WARC archives and a two-level capture index.

Archives are uncompressed WARC files written by Spark's text writer: a record is
one value, and the two line ends that close a record are the line separator.
Of records with equal payloads of some size, the one with the largest page id
holds the payload; the others are revisits that refer to it.

The index has two levels.  Captures are sorted by key (host reversed, then path)
and cut into blocks of compressed lines; a sparse directory keeps the beginning of the
first key of each block.  A search bisects the directory for the blocks that may
hold a key, bisects these blocks, and reads the byte ranges of the records found.
``lookup`` does so for one url; ``search`` and ``fetch`` do so for a table of keys in
tasks, each with one block, or one run of neighbouring records, at a time.  The directory is the
one thing that every task has: blocks grow with the table, so it has at most
``DIRECTORY_ROWS`` rows and one more per part of the index.

Records are read with Arrow's file systems (local, HDFS and object stores).

Defined cases: a NULL payload is empty; a NULL url has no target line and
the empty key; blanks and control characters of a url are written, and looked for, as ``%20``;
rows that repeat page id and payload of a response are responses
too; a NULL page id counts as the smallest; pages of any size are kept whole, large ones in archives
of few records; many captures of one key fill blocks of their own; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..limits import DEFAULT, Limits
from ..operators.skew import is_small
from ..scratch import materialize, scratch_path
from .common import map_arrow

LEAST_BYTES = 1000  # of a payload that may be revisited
FILE_BYTES = 32 << 20
BLOCK_LINES = 2048  # at least
DIRECTORY_ROWS = 1 << 16
KEY_CHARS = 256  # of a key in the directory
RUN_BYTES = 8 << 20  # of neighbouring records that are read at once
DATE = "2000-01-01T00:00:00Z"  # captures have no time of their own
_LINE = "\r\n"
_END = "\r\n\r\n"
# Fixed by the WARC 1.1 standard.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payloads(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    return pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").alias("url"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("bytes"),
        F.sha1(html.cast("binary")).alias("digest"),
    )


def with_originals(rows: DataFrame, least: int = LEAST_BYTES, limits: Limits = DEFAULT) -> DataFrame:
    """Add ``original``, the page id of the response, to records that revisit one."""
    sums = rows.filter(F.col("bytes") >= least).groupBy("digest", "bytes")
    copies = sums.agg(F.count(F.lit(1)).alias("rows"), F.max("page_id").alias("top")).filter("rows > 1")
    copies = materialize(copies.select("digest", "bytes", "top"), "copied_payloads")
    right = F.broadcast(copies) if is_small(copies, limits) else copies.hint("merge")
    other = F.when(~F.col("page_id").eqNullSafe(F.col("top")), F.col("top"))
    return rows.join(right, ["digest", "bytes"], "left").withColumn("original", other).drop("top")


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


_UNFIT = r"[\x00-\x20\x7F]"  # characters of a url that would end its line


def _uri(url: Column) -> Column:
    return F.regexp_replace(url, _UNFIT, "%20")


def records(rows: DataFrame) -> DataFrame:
    """One text per record, without the line ends that close it."""
    revisit = F.col("original").isNotNull()
    payload = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK" + _LINE + "Content-Type: text/html; charset=utf-8" + _LINE + "Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(_END),
    )
    size = F.octet_length(http) + F.octet_length(payload)
    target = F.when(F.col("url").isNull(), F.lit("")).otherwise(F.concat(F.lit("WARC-Target-URI: "), _uri(F.col("url")), F.lit(_LINE)))
    refers = F.when(
        revisit, F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("original")), F.lit(_LINE + f"WARC-Profile: {_PROFILE}" + _LINE))
    ).otherwise(F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1" + _LINE + "WARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(_LINE + "WARC-Record-ID: "),
        record_id(F.col("page_id")),
        F.lit(_LINE + f"WARC-Date: {DATE}" + _LINE),
        target,
        refers,
        F.lit("WARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.lit(_LINE + "Content-Type: application/http; msgtype=response" + _LINE + "Content-Length: "),
        size.cast("string"),
        F.lit(_END),
    )
    return rows.select(F.concat(head, http, payload).alias("value"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST_BYTES, file_bytes: int = FILE_BYTES, **columns) -> None:
    """Write all pages as archives of about ``file_bytes``; rows are written where they are read.

    Pages of up to 64 KB, 1 MB, 16 MB and so on go to archives of their own, with a number of records that follows the
    mean of their class: in whatever order pages come, no file is beyond some 32 times ``file_bytes``.
    """
    rows = payloads(pages, **columns).withColumn("class", F.greatest(F.lit(0), F.ceil(F.log(16.0, (F.col("bytes") + 1) / (1 << 16))).cast("int")))
    classes = rows.groupBy("class").agg(F.avg("bytes").alias("mean")).collect() or [(0, 0.0)]  # sizes end at 2 GB: five rows
    linked = with_originals(rows, least)
    for size, mean in sorted(classes):
        per_file = max(1, int(file_bytes / (mean + 600)))
        out = records(linked.filter(F.col("class") == size)).write.mode("overwrite")
        out.option("lineSep", _END).option("maxRecordsPerFile", per_file).text(f"{path}/size-{size}")


_FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)")
_PAGE = re.compile(r"<urn:x-page:(-?\d+|null)>")


_HEAD = re.compile(rb"\r\n\r\n")


def read_record(data: bytes | memoryview, at: int) -> tuple[dict[str, str], int, int, int]:
    """Fields of the record at ``at``, where its payload starts and ends, and where the next record starts."""
    if data[at : at + 7] != b"WARC/1.":
        raise ValueError(f"no WARC record at byte {at}")
    head = _HEAD.search(data, at)
    fields = {k.decode().lower(): v.decode() for k, v in _FIELD.findall(data, at, head.start())}
    stop = head.end() + int(fields["content-length"])
    return fields, _HEAD.search(data, head.end(), stop).end(), stop, stop + 4


def _page(value: str | None) -> int | None:
    m = _PAGE.fullmatch(value or "")
    return int(m[1]) if m and m[1] != "null" else None


def capture_key(url: str | None) -> str:
    """The host's labels in reverse, then the rest: ``http://a.b.org/x`` is ``org,b,a)/x``.

    The same for a url and for the form of it that stands in a record.
    """
    url = re.sub(_UNFIT, "%20", url or "")
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::\d+)?([^#]*)", url)
    if not m:
        return url
    return ",".join(reversed(m[1].lower().split("."))) + ")" + (m[2] or "/")


_INDEXED = {"key": pa.string(), "page_id": pa.int64(), "record_type": pa.string(), "file": pa.string(), "start": pa.int64(), "stop": pa.int64()}
_INDEXED_SCHEMA = "key string, page_id long, record_type string, file string, start long, stop long"


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds))


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """What the index says of each record of the archives: key, page_id, record_type, file, start, stop (bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data, at, rows = memoryview(content.as_buffer()), 0, []
                while at < len(data):
                    f, _, stop, after = read_record(data, at)
                    rows.append((capture_key(f.get("warc-target-uri")), _page(f["warc-record-id"]), f["warc-type"], file, at, stop))
                    at = after
                    if len(rows) == 8192:
                        yield _batch(rows, _INDEXED)
                        rows = []
                if rows:
                    yield _batch(rows, _INDEXED)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, _INDEXED_SCHEMA)


def build_index(rows: DataFrame, path: str, lines: int = BLOCK_LINES) -> None:
    """Sorted, compressed blocks of captures below ``path``/blocks and their directory below ``path``/directory.

    ``rows`` should be stored.  Blocks have ``lines`` lines, or as many as keep the directory small.
    """
    lines = max(lines, -(-rows.count() // DIRECTORY_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: list[tuple] = []
        number = TaskContext.get().partitionId() << 32  # numbers follow the order of keys

        def block(some: list[tuple]) -> pa.RecordBatch:
            nonlocal number
            text = "\n".join("\t".join(str(x) for x in r) for r in some)
            packed = zlib.compress(text.encode("utf-8", "surrogatepass"), 6)
            number += 1
            values = ([number], [some[0][0][:KEY_CHARS]], [len(some)], [packed])
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], names=["block", "first", "n", "lines"])

        for batch in batches:
            held += zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))
            while len(held) >= lines:
                yield block(held[:lines])
                held = held[lines:]
        if held:
            yield block(held)

    # Very frequent keys are spread by the page id, so ranges stay even.
    order = ["key", "page_id"]
    dealt = rows.select(*_INDEXED).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.mapInArrow(run, "block long, first string, n int, lines binary").write.mode("overwrite").parquet(f"{path}/blocks")
    blocks = rows.sparkSession.read.parquet(f"{path}/blocks")
    named = blocks.select("block", "first", "n", F.col("_metadata.file_path").alias("file"))
    named.write.mode("overwrite").parquet(f"{path}/directory")


class Directory:
    """The sparse directory of an index in memory: beginnings of first keys in order, and block numbers."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        rows = sorted(spark.read.parquet(f"{path}/directory").select("block", "first").collect())
        self.numbers = [r[0] for r in rows]
        self.firsts = [r[1] for r in rows]

    def blocks(self, key: str) -> list[int]:
        """The blocks that may hold a key: that before the first one beginning at it, up to the last that does."""
        least = bisect.bisect_left(self.firsts, key[:KEY_CHARS]) - 1
        return self.numbers[max(least, 0) : bisect.bisect_right(self.firsts, key)]


class _Block:
    """The lines of a block."""

    def __init__(self, lines: bytes) -> None:
        self.rows = [line.split("\t") for line in zlib.decompress(lines).decode("utf-8", "surrogatepass").split("\n")]
        self.keys = [x[0] for x in self.rows]

    def find(self, key: str) -> list[tuple]:
        some = self.rows[bisect.bisect_left(self.keys, key) : bisect.bisect_right(self.keys, key)]
        return [(x[0], None if x[1] == "None" else int(x[1]), x[2], x[3], int(x[4]), int(x[5])) for x in some]


def lookup(spark: SparkSession, path: str, url: str) -> list[dict]:
    """Captures of one url: the directory is bisected for the blocks that may hold it, and only these are read and bisected."""
    key = capture_key(url)
    numbers = Directory(spark, path).blocks(key)
    if not numbers:
        return []
    said = spark.read.parquet(f"{path}/directory").filter(F.col("block").between(numbers[0], numbers[-1]))
    files = [r[0] for r in said.select("file").distinct().collect()]
    blocks = spark.read.parquet(*files).filter(F.col("block").between(numbers[0], numbers[-1])).orderBy("block")
    return [dict(zip(_INDEXED, row)) for r in blocks.toLocalIterator() for row in _Block(r["lines"]).find(key)]


def search(keys: DataFrame, path: str) -> DataFrame:
    """Captures of a table of keys (column ``key``), as ``read_captures`` gives them.

    Each key goes to the blocks that may hold it; there, blocks and their keys follow each other, and one block is
    unpacked at a time.
    """
    spark = keys.sparkSession
    directory = Directory(spark, path)

    def blocks_of(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        pairs = [(number, key) for key in batch.column(0).to_pylist() for number in directory.blocks(key)]
        return _batch(pairs, {"block": pa.int64(), "key": pa.string()}) if pairs else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = None, None
        for batch in batches:
            found: list[tuple] = []
            for at, (here, key) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if key is None:
                    number, block = here, _Block(batch.column(2)[at].as_py())
                elif here == number:
                    found += block.find(key)
                while len(found) >= 8192:
                    yield _batch(found[:8192], _INDEXED)
                    found = found[8192:]
            if found:
                yield _batch(found, _INDEXED)

    asked = map_arrow(keys.select("key").distinct(), blocks_of, "block long, key string").withColumn("lines", F.lit(None).cast("binary"))
    blocks = spark.read.parquet(f"{path}/blocks").select("block", F.lit(None).cast("string").alias("key"), "lines")
    met = blocks.unionByName(asked).repartition("block").sortWithinPartitions("block", F.col("key").asc_nulls_first())
    return met.mapInArrow(run, _INDEXED_SCHEMA)


def _open(uri: str):
    """A file of the archives for reading at any place."""
    from pyarrow import fs

    if uri.startswith("file:") or "://" not in uri:
        return fs.LocalFileSystem().open_input_file(re.sub(r"^file:/*", "/", uri))
    system, place = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))
    return system.open_input_file(place)


def fetch(found: DataFrame) -> DataFrame:
    """Read the byte ranges of captures: key, page_id, file, start, stop, record_type, refers_to, payload_bytes and
    payload_digest, all but the first from the record itself (the digest of a response from the bytes of its payload)."""
    kinds = {
        "key": pa.string(), "page_id": pa.int64(), "file": pa.string(), "start": pa.int64(), "stop": pa.int64(), "record_type": pa.string(),
        "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
    }

    def row(key: str, file: str, start: int, stop: int, data: memoryview) -> tuple:
        f, body, end, _ = read_record(data, 0)
        digest = hashlib.sha1(data[body:end]).hexdigest()
        if f["warc-type"] == "revisit":
            digest = f["warc-payload-digest"].removeprefix("sha1:")
        return key, _page(f["warc-record-id"]), file, start, stop, f["warc-type"], _page(f.get("warc-refers-to")), end - body, digest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            asked = list(zip(*(batch.column(c).to_pylist() for c in ("key", "file", "start", "stop"))))
            rows, at = [], 0
            while at < len(asked):
                _, file, start, stop = asked[at]
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, _open(file)
                upto = at + 1  # neighbours in the file are read together
                while upto < len(asked) and asked[upto][1] == file and asked[upto][2] <= stop + 4 and asked[upto][3] - start <= RUN_BYTES:
                    stop = max(stop, asked[upto][3])
                    upto += 1
                data = memoryview(source.read_at(stop - start, start))
                rows += [row(k, file, a, b, data[a - start : b - start]) for k, _, a, b in asked[at:upto]]
                at = upto
            if rows:
                yield _batch(rows, kinds)
        if source is not None:
            source.close()

    schema = "key string, page_id long, file string, start long, stop long, record_type string, refers_to long, payload_bytes long, payload_digest string"
    dealt = found.select("key", "file", "start", "stop").repartition("file").sortWithinPartitions("file", "start")
    return dealt.mapInArrow(run, schema)


def with_full_sizes(rows: DataFrame) -> DataFrame:
    """Fetched records with the size of their full payload; revisits take it from the response they refer to."""
    said = rows.filter("record_type = 'revisit'")
    asked = said.select(F.col("refers_to").alias("_id")).distinct()
    full = rows.filter("record_type = 'response'").join(asked, F.col("page_id") == F.col("_id"), "left_semi")
    full = full.groupBy(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest")).agg(F.max("payload_bytes").alias("_bytes"))
    full = materialize(full, "responses")
    right = F.broadcast(full) if is_small(full) else full.hint("merge")
    found = said.join(right, (F.col("refers_to") == F.col("_id")) & (F.col("payload_digest") == F.col("_digest")), "left")
    found = found.withColumn("payload_bytes", F.col("_bytes")).select(*rows.columns)
    return rows.filter("record_type = 'response'").unionByName(found)


def read_range(spark: SparkSession, capture: dict) -> bytes:
    """The payload of one capture: its byte range of the archive, by Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(capture["file"])
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where)
    try:
        stream.seek(capture["start"])
        data = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, capture["stop"] - capture["start"]))
    finally:
        stream.close()
    _, body, stop, _ = read_record(data, 0)
    return data[body:stop]


def keys_of(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """The distinct keys of the urls of a table."""
    urls = pages.select(F.col(f"`{url_col}`").cast("string").alias("url")).distinct()
    named = map_arrow(urls, lambda b: pa.RecordBatch.from_arrays([pa.array(map(capture_key, b.column(0).to_pylist()), pa.string())], names=["key"]), "key string")
    return named.distinct()


def archive(pages: DataFrame, path: str | None = None, **columns) -> DataFrame:
    """Write archives and their index, and read back the records of all urls of ``pages`` through the index."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, f"{path}/archives", **columns)
    build_index(materialize(read_captures(spark, f"{path}/archives"), "captures"), f"{path}/index")
    found = search(keys_of(pages, columns.get("url_col", "url")), f"{path}/index")
    return with_full_sizes(materialize(fetch(found), "records"))
