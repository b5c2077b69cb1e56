"""WARC archives: one gzip member per record, written and read back by the tasks.

The writer makes a ``response`` record of each page, and a ``revisit`` record, without the payload, of a page
whose payload of at least ``REVISIT_BYTES`` bytes equals that of a page with a smaller id. Each task writes archives of
its own below a shared folder; what a task wrote counts once its row is in the stored list of archives, so files of
lost attempts are never read. The reader goes through an archive sequentially: it inflates as bytes come in,
frames blocks by their content length, expects every record to be exactly one member, and checks the digests.

A null payload counts as empty. Of rows that share both page id and payload each is written, and all with the
smallest id are responses. A null page id is never referred to. A null url is left out of its record; line breaks
in one are escaped. An empty table writes nothing and reads nothing. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import fresh_path, store
from .common import in_small_batches

REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20
LEVEL = 6
READ_BYTES = 1 << 18
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


def _digest(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(uri: str) -> int | None:
    number = uri.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP headers and leaves the payload out."""
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _uri(page_id),
        "WARC-Date": date,
        "Content-Type": "application/http;msgtype=response",
        "WARC-Block-Digest": _digest(block),
        "WARC-Payload-Digest": _digest(payload),
        "Content-Length": str(len(block)),
    }
    if url is not None:
        fields["WARC-Target-URI"] = url.replace("\r", "%0D").replace("\n", "%0A")
    if refers_to is not None:
        fields |= {"WARC-Refers-To": _uri(refers_to), "WARC-Profile": SAME_PAYLOAD}
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items()).encode()
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(b"%b\r\n%b\r\n%b\r\n\r\n" % (VERSION, head, block)) + packer.flush()


def _parsed(member: bytes) -> Record:
    head, _, rest = member.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version != VERSION:
        raise ValueError(f"no WARC record: {version[:40]!r}")
    headers = dict(line.decode().split(": ", 1) for line in lines)
    length = int(headers["Content-Length"])
    block, end = rest[:length], rest[length:]
    if len(block) != length or end != b"\r\n\r\n":
        raise ValueError(f"{headers.get('WARC-Record-ID')}: block of {len(rest)} bytes, {length} expected")
    if _digest(block) != headers["WARC-Block-Digest"]:
        raise ValueError(f"{headers.get('WARC-Record-ID')}: block digest differs")
    return Record(headers, block)


def read_records(stream: BinaryIO) -> Iterator[Record]:
    """Records of an archive in order; holds one record and one read at a time."""
    inflate, parts, pending = zlib.decompressobj(31), [], b""
    while True:
        data = pending or stream.read(READ_BYTES)
        pending = b""
        if not data:
            break
        parts.append(inflate.decompress(data))
        if inflate.eof:
            pending = inflate.unused_data
            yield _parsed(b"".join(parts))
            inflate, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the archive ends inside a record")


def page_of(record: Record) -> tuple:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to``; checks a response's payload."""
    headers = record.headers
    http, _, payload = record.block.partition(b"\r\n\r\n")
    length = int(http.rpartition(b"Content-Length: ")[2])
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"]
    if kind == "response" and (len(payload) != length or _digest(payload) != digest):
        raise ValueError(f"{headers['WARC-Record-ID']}: payload differs")
    refers_to = _page_id(headers["WARC-Refers-To"]) if kind == "revisit" else None
    return (_page_id(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), length,
            digest.removeprefix("sha256:"), kind, refers_to)


def _first_pages(pages: DataFrame) -> DataFrame:
    """Pages with ``refers_to``. Only payloads that occur more than once are looked up."""
    digest = F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256)
    known = pages.select("page_id", "url", "html", digest.alias("digest"))
    first = (
        known.where(F.octet_length("html") >= REVISIT_BYTES).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    )
    revisit = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    return known.join(first, "digest", "left").select(
        "page_id", "url", "html", F.when(F.col("first").isNotNull() & revisit, F.col("first")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``page_id, url, html`` below a shared folder; the stored list ``path, records, bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        out, name, records, size = None, "", 0, 0

        def listed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "records": records, "bytes": size}])

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                page_id, url, html, refers_to = row
                data = record_bytes(page_id, url, (html or "").encode(), refers_to)
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    yield listed()
                    out = None
        if out is not None:
            yield listed()

    return store(in_small_batches(_first_pages(pages)).mapInArrow(run, "path string, records bigint, bytes bigint"))


def read_archives(archives: DataFrame) -> DataFrame:
    """The pages in the archives of a list with a column ``path``."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = ["bigint", "string", "bigint", "string", "string", "bigint"]
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True))
    arrow = [{"bigint": pa.int64(), "string": pa.string()}[t] for t in types]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow, strict=True)], names=names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, place = fs.FileSystem.from_uri(path)
                rows = []
                with files.open_input_stream(place, compression=None) as stream:
                    for record in read_records(stream):
                        rows.append(page_of(record))
                        if len(rows) == 4096:
                            yield made(rows)
                            rows = []
                if rows:
                    yield made(rows)

    count = archives.count()
    return archives.select("path").repartition(max(1, min(count, 10_000))).mapInArrow(run, schema)


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read those back."""
    return read_archives(write_archives(pages, fresh_path(pages.sparkSession, "warc")))
