"""WARC archives with an index: write, index first, read back by coalesced byte ranges.

Writing: a page whose payload equals that of a page with a larger id becomes a revisit of the largest;
the groups are found on digests, so a payload that a third of the pages share costs one row per task, and
the few columns of that table are all that pages are joined with. Every task writes archives of its own
(one gzip member a record) below the shared folder and yields an index row per record: archive, offset,
length, URL and digest. The index is written as a table. It names only what a successful attempt wrote,
so archives of lost executors are ignored.

Reading: the index rows of the selected records are dealt by ranges of archive and offset, as many as their bytes need;
ranges with small gaps are coalesced into one read of bounded size, parsed, and checked against the digest.

Files are opened through Arrow's file systems, so the shared folder may be local, HDFS or an object store.

Defined cases: a null payload is empty, and empty payloads are equal ones; a null URL has no target header;
control characters in a URL are percent-encoded; all rows that hold a payload's largest id are responses;
a row without id revisits like any other but is only revisited if its whole group has no id (then
all are responses); an empty table gives an index without rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.llm.common import written
from tableloom.session import scratch_path

ARCHIVE_BYTES = 512 << 20
TASK_BYTES = 16 << 20
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
#: A fixed date keeps archives equal when a task runs again.
WHEN = "2000-01-01T00:00:00Z"

INDEX = "archive string, offset bigint, length bigint, url string, digest string"
RECORDS = "page string, payload_bytes bigint, payload_digest string, record_type string, refers_to string"


def opened(folder: str):
    """The file system of a folder and the folder's path there."""
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def safe_url(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record_bytes(page: str, url: str | None, payload: bytes, digest: str, refers: str | None) -> bytes:
    """One record: headers, the response's HTTP headers, and the payload unless it is a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers is not None else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {WHEN}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {safe_url(url)}")
    if refers is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers}>",
        ]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(record: bytes) -> tuple:
    """Page, payload size and digest, type and the page referred to, from a record's bytes."""
    head, _, rest = record.partition(b"\r\n\r\n")
    named = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(named["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = named["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if named["WARC-Type"] == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"damaged record of {named['WARC-Record-ID']}")
    page = re.fullmatch(r"<urn:page:(.*)>", named["WARC-Record-ID"])[1]
    refers = re.fullmatch(r"<urn:page:(.*)>", named["WARC-Refers-To"])[1] if "WARC-Refers-To" in named else None
    return page or None, size, digest, named["WARC-Type"], refers


def payload_groups(pages: DataFrame, page: str, payload: str) -> DataFrame:
    """``same`` (a payload's hash) and ``first`` (its largest page) of payloads with several rows."""
    hashed = pages.select(F.sha2(F.coalesce(F.col(payload), F.lit("")), 256).alias("same"), F.col(page).alias("page"))
    groups = hashed.groupBy("same").agg(F.max("page").alias("first"), F.count(F.lit(1)).alias("n"))
    return written(groups.where((F.col("n") > 1) & F.col("first").isNotNull()).select("same", "first"), "payloads")


def write_archives(pages: DataFrame, folder: str, page: str = "page_id", url: str = "url", payload: str = "html",
                   level: int = 1) -> DataFrame:
    """Write every page as a record below the folder; the index is returned as a written table."""
    groups = payload_groups(pages, page, payload)
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(page).alias("page"), F.col(url).alias("url"), body.alias("body"), F.sha2(body, 256).alias("_same"))
    joined = rows.join(groups, F.col("_same") == F.col("same"), "left").select(
        F.coalesce(F.col("page").cast("string"), F.lit("")).alias("page"), F.col("url").cast("string").alias("url"), "body",
        F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first").cast("string")).alias("refers"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        out, name, offset = None, "", 0
        for batch in batches:
            found = []
            bodies = batch.column(2).cast(pa.binary())
            for i, (number, link, refers) in enumerate(zip(*[batch.column(k).to_pylist() for k in (0, 1, 3)])):
                if out is None or offset >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, offset = f"{uuid4().hex}.warc.gz", 0
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                payload = bodies[i].as_py()
                digest = payload_digest(payload)
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                data = packer.compress(record_bytes(number, link, payload, digest, refers)) + packer.flush()
                out.write(data)
                found.append((name, offset, len(data), link, digest))
                offset += len(data)
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*found) if found else [[]] * 5, kinds)],
                ["archive", "offset", "length", "url", "digest"],
            )
        if out is not None:
            out.close()

    return written(joined.mapInArrow(run, INDEX), "warc-index")


def ranges(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Sorted (archive, offset, length) rows as reads: archive, start, end, and the records inside."""
    at: list = []
    for archive, offset, length in rows:
        if at and at[0] == archive and offset - at[2] <= GAP_BYTES and offset + length - at[1] <= READ_BYTES:
            at[2] = max(at[2], offset + length)
            at[3].append((offset, length))
        else:
            if at:
                yield tuple(at)
            at = [archive, offset, offset + length, [(offset, length)]]
    if at:
        yield tuple(at)


def dealt_by_bytes(index: DataFrame, file: str) -> DataFrame:
    """Index rows in as many ranges of file and offset as the bytes behind them need tasks, sorted.

    The rows themselves are small, so their own size says nothing about the reading.
    """
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // TASK_BYTES))
    return index.repartitionByRange(tasks, file, "offset").sortWithinPartitions(file, "offset")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records an index (or a selection of it) names, read from the archives."""
    ordered = dealt_by_bytes(index.select("archive", "offset", "length"), "archive")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        for batch in batches:
            for archive, start, end, inside in ranges(list(zip(*[c.to_pylist() for c in batch.columns]))):
                with store.open_input_file(f"{base}/{archive}") as source:
                    data = source.read_at(end - start, start)
                found = [parsed(zlib.decompress(data[o - start:o - start + n], 31)) for o, n in inside]
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*found), kinds)],
                    ["page", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                )

    return ordered.mapInArrow(run, RECORDS)


def archived_pages(pages: DataFrame, page: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write the pages, then read every record back: one row per page, ids in the pages' own type."""
    folder = scratch_path(pages.sparkSession, "warc")
    kind = dict(pages.select(F.col(page).alias("page")).dtypes)["page"]
    read = read_records(write_archives(pages, folder, page, url, payload), folder)
    return read.select(
        F.col("page").cast(kind).alias(page), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
