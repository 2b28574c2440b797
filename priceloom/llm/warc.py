"""WARC archives with a two-level capture index.

``write_archives`` turns page rows into WARC records, JVM-side, and writes them
as files of at most RECORDS_PER_FILE records through Spark's own committer: a
file is a plain WARC file. Of records with equal payloads of at least
LEAST_REVISIT bytes the one with the smallest page_id is a response, the others
are revisits that refer to it; smaller payloads are all responses.

``build_index`` reads the archives once and sorts the captures by reversed-host
URL key and record id into compressed blocks of BLOCK_ENTRIES lines; the sparse
block directory keeps the first key of each block only. ``lookup`` searches the
directory by bisection, opens the blocks it points to, bisects them for the
keys, and cuts the byte ranges found out of the archives, which are read whole. The directory is
broadcast after its size was checked; above the bound, keys meet all blocks'
entries by a shuffled join instead, with the same result.

Defined results: null html is an empty payload; a null or unparsable URL is
indexed under its own text, a null one under "-"; control characters and blanks in
URLs are percent-encoded; of equal payloads without any id all are responses;
rows equal in id and payload have equal records; extra columns are not read."""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from priceloom.llm.common import attach, scratch_path, written
from priceloom.llm.exact_dedup import bucket_of, repeated

RECORDS_PER_FILE, LEAST_REVISIT, BLOCK_ENTRIES = 2000, 100, 512
#: Bounds of what is broadcast: first keys, and byte ranges (two longs each).
DIRECTORY_ROWS, BROADCAST_RANGES = 200_000, 1_000_000
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit("\r\n"))


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def clean_url(url: Column) -> Column:
    """No blanks or control characters, which would break a header line."""
    return F.regexp_replace(url, r"[\x00-\x20\x7f]", "%20")


def records(pages: DataFrame, date: str) -> DataFrame:
    """One column ``value``: each row's WARC record without its end mark."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), clean_url(F.col("url")).alias("url"), html.alias("html"))
    rows = rows.withColumns({"size": F.octet_length("html").cast("long"), "digest": F.sha2(F.col("html").cast("binary"), 256)})
    keys = written(rows.filter(F.col("size") >= LEAST_REVISIT).select("page_id", "digest"), "payloads")
    groups = keys.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("times")).filter("times > 1")
    groups = written(groups, "equal-payloads")
    again = repeated(keys, "digest")
    tagged = rows.withColumn("bucket", F.when(F.col("size") >= LEAST_REVISIT, bucket_of("digest")).otherwise(F.lit(-1)))
    alone = tagged.join(again, "bucket", "left_anti").withColumn("first", F.col("page_id"))
    shared = attach(tagged.join(again, "bucket", "left_semi"), groups, ["digest"], "times", keys.count()).drop("times")
    # a bucket may hold a digest that does not occur again
    shared = shared.withColumn("first", F.coalesce("first", "page_id"))
    every = alone.unionByName(shared)
    revisit = ~F.col("page_id").eqNullSafe(F.col("first"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.lit("\r\n\r\n"),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.concat(http, F.col("html")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        F.when(revisit, _line("WARC-Type", "revisit")).otherwise(_line("WARC-Type", "response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Date", date),
        F.when(F.col("url").isNull(), F.lit("")).otherwise(_line("WARC-Target-URI", F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("Payload-Length", F.col("size").cast("string")),
        F.when(revisit, F.concat(_line("WARC-Refers-To", _record_id(F.col("first"))), _line("WARC-Profile", PROFILE))).otherwise(F.lit("")),
        _line("Content-Type", "application/http; msgtype=response"),
        _line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
    )
    return every.select(F.concat(head, body).alias("value"))


def write_archives(pages: DataFrame, path: str, date: str = "2020-01-01T00:00:00Z") -> None:
    writer = records(pages, date).write.option("lineSep", END.decode()).option("maxRecordsPerFile", RECORDS_PER_FILE)
    writer.text(path)


def url_key(url: str | None) -> str:
    """The reversed-host key: com,example,www)/path?query, in lower case."""
    if url is None:
        return "-"
    try:
        parts = urlsplit(url)
        host, port = parts.hostname, parts.port
    except ValueError:
        return url
    if not host:
        return url
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (parts.path or "/")
    return (key + (f"?{parts.query}" if parts.query else "")).lower()


def capture_key(url: str | None, page: str) -> str:
    """Unique among captures: the URL key and the page id, numbers in order."""
    return f"{url_key(url)} {page.zfill(20)}"


def parse(content: bytes | memoryview, start: int) -> tuple[dict[str, str], int, int]:
    """Headers of the record at ``start``, where its block begins, its end."""
    content = bytes(content) if not isinstance(content, bytes) else content
    at = content.index(END, start)
    lines = content[start:at].decode("utf-8", "replace").split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    begin = at + len(END)
    return headers, begin, begin + int(headers["Content-Length"])


def _page(headers: dict[str, str], name: str = "WARC-Record-ID") -> str:
    return headers[name].removeprefix("<urn:page:").removesuffix(">")


def _captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            whole, at = content.as_py(), 0
            keys, starts, sizes = [], [], []
            while at < len(whole):
                headers, _, end = parse(whole, at)
                keys.append(capture_key(headers.get("WARC-Target-URI"), _page(headers)))
                starts.append(at)
                sizes.append(end - at)
                at = end + len(END)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([path.as_py()] * len(keys), pa.string()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())],
                ["key", "file", "start", "size"],
            )


def _blocks(entries: int):
    """Blocks of sorted entries; entries with one key stay in one block."""

    def closed(lines: list[tuple[str, str]]) -> pa.RecordBatch:
        data = zlib.compress("\n".join(line for _, line in lines).encode())
        return pa.RecordBatch.from_arrays(
            [pa.array([lines[0][0]]), pa.array([len(lines)], pa.int32()), pa.array([data], pa.binary())], ["first_key", "entries", "data"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, str]] = []
        for batch in batches:
            for key, file, start, size in zip(*(batch.column(c).to_pylist() for c in ("key", "file", "start", "size"))):
                if len(held) >= entries and held[-1][0] != key:
                    yield closed(held)
                    held = []
                held.append((key, f"{key}\t{file}\t{start}\t{size}"))
        if held:
            yield closed(held)

    return run


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def build_index(spark: SparkSession, archives: str, index: str, entries: int = BLOCK_ENTRIES) -> None:
    captures = written(_files(spark, archives).mapInArrow(_captures, "key string, file string, start long, size long"), "captures")
    shards = max(1, -(-captures.count() // (64 * entries)))
    ordered = captures.repartitionByRange(shards, "key").sortWithinPartitions("key", "file", "start")
    ordered.mapInArrow(_blocks(entries), "first_key string, entries int, data binary").write.parquet(index)


def _entries(data: bytes) -> tuple[list[str], list[list[str]]]:
    rows = [line.rsplit("\t", 3) for line in zlib.decompress(data).decode().split("\n")]
    return [r[0] for r in rows], rows


def _found(keys: list[str], rows: list[list[str]], wanted: list[str] | None) -> Iterator[list[str]]:
    if wanted is None:
        yield from rows
        return
    for key in wanted:
        yield from rows[bisect_left(keys, key) : bisect_right(keys, key)]


def _open_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of the wanted keys of each block, or of all where none are named."""
    for batch in batches:
        named = "wanted" in batch.schema.names
        for i in range(batch.num_rows):
            keys, rows = _entries(batch.column("data")[i].as_py())
            got = list(_found(keys, rows, batch.column("wanted")[i].as_py() if named else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in got], pa.string()), pa.array([r[1] for r in got], pa.string())]
                + [pa.array([int(r[c]) for r in got], pa.int64()) for c in (2, 3)],
                ["key", "file", "start", "size"],
            )


def locate(spark: SparkSession, index: str, keys: DataFrame) -> DataFrame:
    """(file, start, size) of the captures with one of the given keys."""
    entry = "key string, file string, start long, size long"
    blocks = spark.read.parquet(index)
    keys = keys.select("key").distinct()
    if blocks.count() > DIRECTORY_ROWS:
        return blocks.select("data").mapInArrow(_open_blocks, entry).join(keys, "key", "left_semi")
    directory = sorted(r.first_key for r in blocks.select("first_key").toLocalIterator())
    held = spark.sparkContext.broadcast(directory)

    def point(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = held.value
        for batch in batches:
            wanted = batch.column("key").to_pylist()
            at = [bisect_right(firsts, k) - 1 for k in wanted]
            yield pa.RecordBatch.from_arrays(
                [pa.array([firsts[max(a, 0)] if firsts else None for a in at], pa.string()), pa.array(wanted, pa.string())], ["first_key", "key"]
            )

    asked = keys.mapInArrow(point, "first_key string, key string").groupBy("first_key").agg(F.collect_list("key").alias("wanted"))
    return blocks.join(asked, "first_key").select("data", "wanted").mapInArrow(_open_blocks, entry)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content, spans in zip(batch.column("content"), batch.column("spans")):
            whole = content.as_py()
            out: list[tuple] = []
            for span in spans.as_py():
                record = whole[span["start"] : span["start"] + span["size"]]
                headers, begin, end = parse(record, 0)
                kind, page = headers["WARC-Type"], _page(headers)
                if kind == "response":
                    payload = record[record.index(END, begin) + len(END) : end]
                    size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                else:
                    payload, size = None, int(headers["Payload-Length"])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                refers = int(_page(headers, "WARC-Refers-To")) if kind == "revisit" else None
                out.append((None if page == "null" else int(page), headers.get("WARC-Target-URI"), kind, refers, size, digest, payload))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            columns = list(zip(*out)) or [()] * len(kinds)
            names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def read_captures(spark: SparkSession, archives: str, located: DataFrame) -> DataFrame:
    """The records at the given places: page_id, url, record_type, refers_to,
    payload_bytes, payload_digest and payload (null for revisits)."""
    spans = located.groupBy("file").agg(F.collect_list(F.struct("start", "size")).alias("spans"))
    spans = spans.withColumnRenamed("file", "path")
    if located.count() <= BROADCAST_RANGES:
        spans = F.broadcast(spans)
    joined = _files(spark, archives).join(spans, "path").select("content", "spans")
    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    return joined.mapInArrow(_ranges, schema)


def capture_keys(pages: DataFrame) -> DataFrame:
    """The index keys of page rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [capture_key(u, p) for u, p in zip(batch.column("url").to_pylist(), batch.column("page").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], ["key"])

    page = F.coalesce(F.col("page_id").cast("long").cast("string"), F.lit("null")).alias("page")
    return pages.select(clean_url(F.col("url")).alias("url"), page).mapInArrow(run, "key string")


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes the archives and their index to the shared folder and looks every
    page up again."""
    archives, index = scratch_path(spark, "warc"), scratch_path(spark, "warc-index")
    write_archives(pages, archives)
    build_index(spark, archives, index)
    located = written(locate(spark, index, capture_keys(pages)), "located")
    return read_captures(spark, archives, located)
