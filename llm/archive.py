"""Legacy archive converter: ARC files of versions 1 and 2 to WARC 1.1.

An ARC file starts with a version block that names the fields of the header
lines behind it; each record is a header line and as many bytes as it declares.
The converter reads records by those lengths and synthesises what WARC asks for
and ARC lacks: identifiers, ISO timestamps, record types, block and payload
digests. Of records with equal payloads one is a response, the others revisit it
and store no payload.

Files are read and written by Spark, so they may lie in any store. A task begins
a new archive when one is full, so an archive's size, and what a reader holds of
it, doesn't depend on how the input is split. Archives are read twice, first for the narrow digests that settle
which records are repeats, then for the payloads; a payload is moved once at
most. Payloads must be UTF-8 text, as Spark's writer of whole files knows text
alone; others raise an error.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import shared_dir, ship, staged

#: The fields of a header line in each version of the format.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURED = "20240101000000"
#: Records that a task hands on at once.
AT_ONCE = 64
#: Bytes of an archive before compression; a larger record is an archive of its own.
ARCHIVE_BYTES = 16 << 20

_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ------------------------------------------------------------------ ARC


def arc_header(version: int, url: str, size: int, offset: int, name: str, checksum: str, date: str = CAPTURED, mime: str = "text/html") -> str:
    known = {
        "URL": url,
        "IP-address": "0.0.0.0",
        "Archive-date": date,
        "Content-type": mime,
        "Result-code": "200",
        "Checksum": checksum,
        "Location": "-",
        "Offset": str(offset),
        "Filename": name,
        "Archive-length": str(size),
    }
    return " ".join(known[f] for f in FIELDS[version].split())


def version_block(version: int, name: str) -> str:
    body = f"{version} 0 pages\n{FIELDS[version]}\n"
    return arc_header(version, f"filedesc://{name}", len(body), 0, name, "-", mime="text/plain") + "\n" + body


def _page_document(page_id: int | None, payload: bytes) -> bytes:
    number = "" if page_id is None else str(page_id)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {number}\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload


def _archive(records: list[str], between: str) -> pa.RecordBatch:
    """One row that is written as one file."""
    return pa.RecordBatch.from_arrays([pa.array([between.join(records)], pa.string())], names=["value"])


def write_arc(pages: DataFrame, path: str) -> None:
    """Pages as legacy archives, files of version 1 and 2 in turn.

    A missing html is an empty payload; white space and control characters of a
    url are percent-encoded, and a missing url is urn:page:<id>.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, k = TaskContext.get().partitionId(), 0

        def begin() -> tuple[int, str, int, list[str]]:
            version, name = 1 + (number + k) % 2, f"pages-{number:06d}-{k:06d}.arc"
            first = version_block(version, name)
            return version, name, len(first.encode()) + 1, [first]

        version, name, offset, out = begin()
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                for page_id, url, html in zip(*(c.to_pylist() for c in batch.slice(at, AT_ONCE).columns)):
                    payload = (html or "").encode()
                    body = _page_document(page_id, payload)
                    safe = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url or "") or f"urn:page:{page_id}"
                    if len(out) > 1 and offset + len(body) > ARCHIVE_BYTES:
                        yield _archive(out, "\n")
                        k += 1
                        version, name, offset, out = begin()
                    line = arc_header(version, safe, len(body), offset, name, hashlib.md5(payload).hexdigest())
                    out.append(line + "\n" + body.decode())
                    offset += len(line.encode()) + len(body) + 2
        yield _archive(out, "\n")

    ship(pages.sparkSession)
    records = pages.select("page_id", "url", "html").mapInArrow(task, "value string")
    records.write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", 1).option("zlib.compress.level", "BEST_SPEED").text(path)


def read_arc(stream: BinaryIO) -> Iterator[dict]:
    """The records of an ARC file behind its version block, as header fields, ``offset``, ``archive`` and ``body``."""
    line = stream.readline()
    first = line.decode("utf-8", "replace").rstrip("\n").split(" ")
    if not first[0].startswith("filedesc://"):
        raise ValueError("an ARC file starts with a version block")
    block = stream.read(int(first[-1]))
    version_line, names = block.decode("utf-8", "replace").split("\n")[:2]
    version = int(version_line.split(" ")[0])
    if version not in FIELDS:
        raise ValueError(f"unknown ARC version {version}")
    fields = names.split(" ")
    archive = first[0].removeprefix("filedesc://")
    offset = len(line) + len(block)
    while line := stream.readline():
        if line != b"\n":  # records are set apart by a line break
            values = line.decode("utf-8", "replace").rstrip("\n").split(" ")
            if len(values) != len(fields):
                raise ValueError(f"{archive}, offset {offset}: {len(values)} header fields, version {version} has {len(fields)}")
            record = dict(zip(fields, values))
            size = int(record["Archive-length"])
            body = stream.read(size)
            if len(body) != size:
                raise ValueError(f"{archive}, offset {offset}: the archive ends inside a record")
            yield record | {"archive": archive, "offset": offset, "body": body}
            offset += size
        offset += len(line)


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """HTTP headers with the empty line, and the payload."""
    at = body.find(b"\r\n\r\n")
    return (body[: at + 4], body[at + 4 :]) if at >= 0 else (b"", body)


def http_field(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)\r?$", head)
    return m[1].decode() if m and m[1] else None


# ------------------------------------------------------------------ WARC


def record_id(archive: str, offset: int) -> str:
    """The identifier of a converted record: the same whenever the archive is converted."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'arc:{archive}#{offset}')}"


def warc_date(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> str:
    """A record without the two line breaks that end it."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n" + block.decode()


def _records(archives: DataFrame, with_body: bool) -> DataFrame:
    """ARC records with the page id, digest and size of their payloads."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                raw = content.as_buffer() if hasattr(content, "as_buffer") else content.as_py()
                out = []
                for r in read_arc(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(raw)), 1 << 16)):
                    head, payload = split_http(r["body"])
                    page = http_field(head, "X-Page-Id")
                    row = {
                        "record_id": record_id(r["archive"], r["offset"]),
                        "page_id": None if page is None else int(page),
                        "url": r["URL"],
                        "date": warc_date(r["Archive-date"]),
                        "payload_bytes": len(payload),
                        "payload_digest": sha1_base32(payload),
                    }
                    if with_body:
                        row |= {"ip": r["IP-address"], "head": head.decode(), "payload": payload.decode()}
                    out.append(row)
                    if len(out) == AT_ONCE:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out = []
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)

    names = "record_id string, page_id long, url string, date string, payload_bytes long, payload_digest string"
    schema = [("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("date", pa.string())]
    schema += [("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    if with_body:
        names += ", ip string, head string, payload string"
        schema += [("ip", pa.string()), ("head", pa.string()), ("payload", pa.string())]
    schema = pa.schema(schema)
    return archives.select("content").mapInArrow(task, names)


def archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of every archive file in a folder."""
    ship(spark)
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = 0) -> None:
    """ARC files to WARC files, with repeated payloads of at least ``least`` bytes as revisits.

    The response is the record with the smallest page id (a missing one is the
    largest), of repeated pages the one with the smallest identifier.
    """
    found = archives(spark, arc_path)
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "record_id", "url", "date")
    counted = _records(found, False).filter(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes")
    counted = counted.agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = staged(
        counted.select(
            "payload_digest",
            "payload_bytes",
            F.col("first.record_id").alias("first_id"),
            F.col("first.url").alias("first_url"),
            F.col("first.date").alias("first_date"),
        ),
        "repeated-payloads",
    )
    records = _records(found, True).join(firsts, ["payload_digest", "payload_bytes"], "left")
    columns = ["record_id", "url", "date", "ip", "head", "payload", "payload_digest", "first_id", "first_url", "first_date"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, k = TaskContext.get().partitionId(), 0
        info = b"software: legacy archive converter\r\nformat: WARC File Format 1.1\r\n"

        def begin() -> list[str]:
            fields = [
                ("WARC-Type", "warcinfo"),
                ("WARC-Record-ID", f"<{record_id(f'warcinfo-{number}', k)}>"),
                ("WARC-Date", warc_date(CAPTURED)),
                ("Content-Type", "application/warc-fields"),
            ]
            return [warc_record(fields, info)]

        out, size = begin(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                for r in batch.slice(at, AT_ONCE).to_pylist():
                    repeat = r["first_id"] is not None and r["first_id"] != r["record_id"]
                    block = r["head"].encode() if repeat else (r["head"] + r["payload"]).encode()
                    fields = [
                        ("WARC-Type", "revisit" if repeat else "response"),
                        ("WARC-Record-ID", f"<{r['record_id']}>"),
                        ("WARC-Date", r["date"]),
                        ("WARC-Target-URI", r["url"]),
                        ("WARC-IP-Address", r["ip"]),
                        ("WARC-Payload-Digest", f"sha1:{r['payload_digest']}"),
                        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
                        ("Content-Type", "application/http; msgtype=response"),
                    ]
                    if repeat:
                        fields += [
                            ("WARC-Profile", REVISIT_PROFILE),
                            ("WARC-Refers-To", f"<{r['first_id']}>"),
                            ("WARC-Refers-To-Target-URI", r["first_url"]),
                            ("WARC-Refers-To-Date", r["first_date"]),
                        ]
                    more = len(block) + sum(len(name) + len(value) for name, value in fields)
                    if len(out) > 1 and size + more > ARCHIVE_BYTES:
                        yield _archive(out, "\r\n\r\n")
                        k += 1
                        out, size = begin(), 0
                    out.append(warc_record(fields, block))
                    size += more
        yield _archive(out, "\r\n\r\n")

    written = records.select(*columns).mapInArrow(task, "value string").write
    written.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", 1).option("zlib.compress.level", "BEST_SPEED").text(warc_path)


def read_warc(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of every record of a WARC file, by the declared lengths."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a WARC record starts with its version")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            key, _, value = line.decode().partition(":")
            fields[key.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("the archive ends inside a record")
        yield fields, block


def warc_pages(spark: SparkSession, warc_path: str) -> DataFrame:
    """(record_id, page_id, payload_bytes, payload_digest, record_type, refers_id) of every response and revisit.

    Digests are computed again from what is stored and must agree with the fields.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                raw = content.as_buffer() if hasattr(content, "as_buffer") else content.as_py()
                out = []
                for fields, block in read_warc(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(raw)), 1 << 16)):
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    head, payload = split_http(block)
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    if fields["warc-block-digest"] != f"sha1:{sha1_base32(block)}" or kind == "response" and sha1_base32(payload) != digest:
                        raise ValueError(f"{fields['warc-record-id']}: what is stored has another digest")
                    page = http_field(head, "X-Page-Id")
                    out.append(
                        {
                            "record_id": fields["warc-record-id"].strip("<>"),
                            "page_id": None if page is None else int(page),
                            "payload_bytes": int(http_field(head, "Content-Length") or 0),
                            "payload_digest": digest,
                            "record_type": kind,
                            "refers_id": fields.get("warc-refers-to", "").strip("<>") or None,
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    names = "record_id string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_id string"
    schema = pa.schema([(n.split()[0], pa.int64() if n.endswith("long") else pa.string()) for n in names.split(", ")])
    return archives(spark, warc_path).select("content").mapInArrow(task, names)


def with_referred_page(records: DataFrame) -> DataFrame:
    """Records with refers_to, the page id of the response that a revisit names."""
    stored = staged(records, "warc-records")
    named = stored.filter("refers_id IS NOT NULL").select(F.col("refers_id").alias("id")).distinct()
    responses = stored.filter("record_type = 'response'").select(F.col("record_id").alias("id"), F.col("page_id").alias("refers_to"))
    referred = staged(responses.join(named, "id", "left_semi"), "referred")
    joined: Column = F.col("refers_id") == F.col("id")
    return stored.join(referred, joined, "left").drop("id")


def archived_pages(pages: DataFrame, least: int = 0) -> DataFrame:
    """One row per page, read from WARC files that were converted from ARC files of the pages.

    Columns page_id, payload_bytes, payload_digest, record_type, refers_to. Null
    html is an empty payload; null and repeated page ids and urls are records of
    their own; an empty table gives archives without pages and no rows.
    """
    spark = pages.sparkSession
    arc, warc = shared_dir(spark, "arc"), shared_dir(spark, "warc")
    write_arc(pages, arc)
    convert(spark, arc, warc, least)
    found = with_referred_page(warc_pages(spark, warc))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
