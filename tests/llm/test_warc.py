import hashlib
from collections import defaultdict
from pathlib import Path

import pytest

from priceloom.llm import warc
from priceloom.llm.common import scratch_path

SCHEMA = "page_id long, url string, html string, first string, bucket int"


@pytest.fixture(scope="module")
def rows():
    same, tiny = "<p>same " + "x" * 120, "tiny"
    rows = [(i, f"http://www.Example{i % 7}.org:80{i % 10}/p?q={i}", f"<html>{i} é\r\n\r\nWARC/1.1\r\n" + "y" * (i * 7), "f", 1) for i in range(60)]
    rows += [(100 + i, "http://a.b/c", same, "f", 1) for i in range(30)] + [(200 + i, None, tiny, "f", 1) for i in range(3)]
    rows += [(300, "not a url\n", None, "f", 1), (301, "http://[bad", "", "f", 1), (None, None, same, "f", 1), (302, "", "z" * 400_000, None, None)]
    return rows + [rows[0]]


@pytest.fixture(scope="module")
def pages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def brute_force(rows):
    by = defaultdict(list)
    for r in rows:
        by[(r[2] or "").encode()].append(r[0])
    out = []
    for payload, ids in by.items():
        first = min((i for i in ids if i is not None), default=None)
        for i in ids:
            again = len(payload) >= 100 and i != first
            out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


@pytest.mark.parametrize("limit", [warc.DIRECTORY_ROWS, 0])
def test_round_trip_against_brute_force(spark, monkeypatch, pages, rows, limit):
    monkeypatch.setattr(warc, "DIRECTORY_ROWS", limit)
    monkeypatch.setattr(warc, "BROADCAST_RANGES", limit)
    assert result(warc.round_trip(spark, pages)) == brute_force(rows)


def test_lookup_reads_only_what_is_asked(spark, pages, rows):
    archives, index = scratch_path(spark, "w"), scratch_path(spark, "i")
    warc.write_archives(pages, archives)
    warc.build_index(spark, archives, index, entries=8)
    assert spark.read.parquet(index).count() > 5
    asked = pages.filter("page_id in (3, 105, 201, 300)").union(pages.limit(0))
    located = warc.locate(spark, index, warc.capture_keys(asked))
    found = warc.read_captures(spark, archives, located).collect()
    assert sorted(r["page_id"] for r in found) == [3, 105, 201, 300]
    by = {r["page_id"]: r for r in found}
    assert bytes(by[3]["payload"]).decode() == rows[3][2] and by[105]["payload"] is None and by[105]["refers_to"] == 100
    missing = pages.filter("page_id = 3").selectExpr("page_id + 5000 as page_id", "url")
    assert warc.locate(spark, index, warc.capture_keys(missing)).count() == 0


def test_files_are_plain_archives(spark, pages, rows):
    archives = scratch_path(spark, "w")
    warc.write_archives(pages, archives)
    n = 0
    for file in Path(archives.removeprefix("file:")).glob("part-*"):
        content, at = file.read_bytes(), 0
        while at < len(content):
            headers, begin, end = warc.parse(content, at)
            assert content[at:].startswith(b"WARC/1.1\r\n") and content[end : end + 4] == warc.END
            at, n = end + 4, n + 1
    assert n == len(rows)


def test_url_keys():
    assert warc.url_key("http://Blog.Example.com/A?b=1#c") == "com,example,blog)/a?b=1"
    assert warc.url_key("https://x.org:8443") == "org,x:8443)/" and warc.url_key(None) == "-"
    assert warc.url_key("no url") == "no url"


def test_empty_table(spark, pages):
    assert warc.round_trip(spark, pages.limit(0)).count() == 0
