"""WARC archives written with an index, and read back by coalesced byte ranges.

Every record is a gzip member of its own. Writing returns the index: archive, offset, length, URL, payload digest per
record. A reader selects rows of the index, sorts them by place, joins neighbouring byte ranges into one read of bounded
size, and cuts the records out of it.

A task writes archives of bounded size under names of its own, and an index row exists only for a task that succeeded, so
a repeated task leaves at most an archive that no index row names.
"""

from __future__ import annotations

import base64
import hashlib
import io
import os
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curbside.llm.common import staged
from curbside.session import scratch_path

ARCHIVE = 64 << 20  # bytes after which a task begins the next archive
READ, GAP = 8 << 20, 64 << 10  # a read spans at most READ and one record; gaps up to GAP are read over
TASK_READS = 4  # reads of a task
LEVEL = 1
MIN_BYTES = 0
DATE = "2000-01-01T00:00:00Z"  # records are a function of their row, so a repeated task writes the same bytes

INDEX = "archive string, offset long, length long, url string, digest string"
RECORD = "page_id long, url string, record_type string, payload_digest string, payload binary, refers_to long"


@contextmanager
def _opened(path: str, mode: str) -> Iterator[io.IOBase]:
    """A file in the shared folder: a mounted path, or a store that Arrow can reach."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        if mode == "wb":
            os.makedirs(os.path.dirname(parts.path), exist_ok=True)
        with open(parts.path, mode) as f:
            yield f
    else:
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
        with (store.open_output_stream(inner) if mode == "wb" else store.open_input_file(inner)) as f:
            yield f


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                 revisit: bool) -> bytes:
    """One record; a revisit has the HTTP head but no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    name = f"{page_id}|{url}|{digest}"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisit:
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.append(("X-Refers-To-Page-ID", str(refers_to)))
    fields.append(("Content-Length", str(len(block))))
    header = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return header.encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of one record, as they are in it."""
    header, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = header.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    length = int(fields["Content-Length"])
    if version != "WARC/1.1" or rest[length:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    block = rest[:length]
    revisit = fields["WARC-Type"] == "revisit"
    payload = None if revisit else block.partition(b"\r\n\r\n")[2]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if payload is not None and sha1_base32(payload) != digest:
        raise ValueError("the payload does not have its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
        "payload_digest": digest, "payload": payload, "refers_to": number("X-Refers-To-Page-ID"),
    }


def plan_revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """The pages with ``refers_to``: the smallest page of an equal payload, where that is another one.

    Payloads below ``min_bytes`` bytes never refer. Rows that share the smallest page_id are all responses; a page
    without an id refers to one that has it.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    digest = [F.sha1("payload").alias("d"), F.octet_length("payload").alias("n")]
    first = (
        rows.select("page_id", *digest).filter(F.col("n") >= min_bytes)
        .groupBy("d", "n").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .filter("copies > 1").drop("copies")
    )
    return rows.select("*", *digest).join(first, ["d", "n"], "left").select(
        "page_id", "url", "payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE) -> DataFrame:
    """Write page_id, url, payload, refers_to as records; returns the index. Evaluate it once: it writes."""

    schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()),
                        ("digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: dict[str, list] = {c: [] for c in ("archive", "offset", "length", "url", "digest")}
        stream, place, opened = None, 0, None
        try:
            for batch in batches:
                for page in batch.to_pylist():
                    payload = page["payload"]
                    digest = sha1_base32(payload)
                    record = record_bytes(page["page_id"], page["url"], payload, digest, page["refers_to"],
                                          page["refers_to"] is not None)
                    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    member = packer.compress(record) + packer.flush()
                    if stream is None or place >= archive_bytes:
                        if opened is not None:
                            opened.__exit__(None, None, None)
                        path, place = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz", 0
                        opened = _opened(path, "wb")
                        stream = opened.__enter__()
                    stream.write(member)
                    for c, v in zip(index, (path, place, len(member), page["url"], digest), strict=True):
                        index[c].append(v)
                    place += len(member)
                if index["archive"]:
                    yield pa.RecordBatch.from_pydict(index, schema=schema)
                    index = {c: [] for c in index}
        finally:
            if opened is not None:
                opened.__exit__(None, None, None)

    return rows.mapInArrow(run, INDEX)


def coalesced(index: DataFrame, read_bytes: int = READ) -> DataFrame:
    """Sorted byte ranges per read: archive and parts (offset, length), which span ``read_bytes`` and one record at most."""
    section = F.floor(F.col("offset") / read_bytes)
    parts = F.sort_array(F.collect_list(F.struct("offset", "length")))
    return index.groupBy("archive", section.alias("section")).agg(parts.alias("parts")).select("archive", "parts")


def read_records(index: DataFrame, read_bytes: int = READ, gap: int = GAP) -> DataFrame:
    """The records that the rows of an index name."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with _opened(row["archive"], "rb") as f:
                    for run in runs(row["parts"], gap):
                        start = run[0]["offset"]
                        f.seek(start)
                        data = memoryview(f.read(max(p["offset"] + p["length"] for p in run) - start))
                        found = [
                            parse_record(zlib.decompress(data[p["offset"] - start : p["offset"] - start + p["length"]], 31))
                            for p in run
                        ]
                        columns = {c: [x[c] for x in found] for c in found[0]}
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(columns[n], type=t) for n, t in types], names=[n for n, _ in types])

    types = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
             ("payload_digest", pa.string()), ("payload", pa.binary()), ("refers_to", pa.int64())]
    # The ranges are few bytes but stand for many, so their number says how many tasks read them.
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = -(-total // (TASK_READS * read_bytes)) or 1
    return coalesced(index, read_bytes).repartition(tasks, "archive", "parts").mapInArrow(work, RECORD)


def runs(parts: list[dict], gap: int) -> list[list[dict]]:
    """Sorted byte ranges, parted where more than ``gap`` bytes lie between."""
    out: list[list[dict]] = []
    end = None
    for p in parts:
        if end is None or p["offset"] > end + gap:
            out.append([])
        out[-1].append(p)
        end = p["offset"] + p["length"]
    return out


def archive_pages(pages: DataFrame, min_bytes: int = MIN_BYTES) -> tuple[DataFrame, DataFrame, str]:
    """Write all pages; returns the index, the records read back through it, and the folder of the archives."""
    folder = scratch_path(pages.sparkSession, "warc")
    index, _ = staged(write_archives(plan_revisits(pages, min_bytes), folder), "warc-index")
    return index, read_records(index), folder


def digests(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Per page what the archives say of it; a revisit's payload size is that of the record it refers to."""
    _, records, _ = archive_pages(pages, min_bytes)
    read, _ = staged(records.select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        "payload_digest", "record_type", "refers_to"), "warc-records")
    sizes = read.filter("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(
        F.max("payload_bytes").alias("target_bytes"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    plain = read.filter("record_type = 'response'").select(*columns)
    revisits = read.filter("record_type = 'revisit'").drop("payload_bytes").join(
        sizes, ["refers_to", "payload_digest"], "left").withColumnRenamed("target_bytes", "payload_bytes")
    return plain.unionByName(revisits.select(*columns))
