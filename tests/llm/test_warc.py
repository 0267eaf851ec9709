import base64
import gzip
import hashlib
import os

from curbside.llm import warc

SCHEMA = "page_id long, url string, html string, digest int"
PAGES = [
    (4, "http://a/ü?x=1", "<p>é\r\n\r\nx</p>", 1), (2, "http://b/", "<p>é\r\n\r\nx</p>", 1), (9, None, "<p>é\r\n\r\nx</p>", 1),
    (5, "u\r\nv", None, 1), (6, "http://c/", "", 1), (7, "http://d/", "alone", 1), (None, "http://e/", "alone", 1),
    (8, "http://f/", "y" * 300_000, 1), (2, "http://b/", "<p>é\r\n\r\nx</p>", None), (None, None, "no id", 1),
]


def plain(pages, min_bytes=0):
    out = []
    for page, _, html, _ in pages:
        data = (html or "").encode()
        same = [p for p, _, h, _ in pages if (h or "") == (html or "") and p is not None]
        first = min(same) if same and len(data) >= min_bytes else None
        refers = first if first != page else None
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def test_equals_plain_version(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    for least in (0, 1, 10):
        got = warc.digests(pages, least).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        assert sorted(map(tuple, got.collect()), key=repr) == plain(PAGES, least)


def test_index_selects_byte_ranges(spark):
    index, records, folder = warc.archive_pages(spark.createDataFrame(PAGES, SCHEMA).coalesce(1))
    rows = index.orderBy("offset").collect()
    assert len({r.archive for r in rows}) == 1
    assert [r.offset for r in rows[1:]] == [r.offset + r.length for r in rows[:-1]]
    data = open(rows[0].archive.removeprefix("file:"), "rb").read()
    assert len(data) == rows[-1].offset + rows[-1].length
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == len(PAGES)
    some = index.filter("url = 'http://f/' or url = 'http://b/'")
    got = warc.read_records(some, read_bytes=100, gap=0).collect()
    assert sorted(r.page_id for r in got) == [2, 2, 8]
    assert {bytes(r.payload) for r in got if r.page_id == 8} == {b"y" * 300_000}
    assert os.path.isdir(folder.removeprefix("file:"))


def test_runs_and_archives(spark):
    parts = [{"offset": o, "length": 10} for o in (0, 10, 25, 100)]
    assert [[p["offset"] for p in r] for r in warc.runs(parts, 5)] == [[0, 10, 25], [100]]
    rows = warc.plan_revisits(spark.createDataFrame(PAGES, SCHEMA).coalesce(1))
    index = warc.write_archives(rows.coalesce(1), warc.scratch_path(spark, "warc"), archive_bytes=200)
    index, _ = warc.staged(index, "warc-index")
    assert index.select("archive").distinct().count() > 2
    assert warc.read_records(index).count() == len(PAGES)


def test_empty_table(spark):
    assert warc.digests(spark.createDataFrame([], SCHEMA)).count() == 0
